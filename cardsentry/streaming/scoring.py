"""Micro-batch fraud scoring with cross-batch card history.

Window functions are not allowed on a streaming DataFrame, so features are
computed inside ``foreachBatch``, where each micro-batch is a batch DataFrame,
by the same ``compute_features`` the batch fact uses.  Each batch is unioned
with the stored history of its cards; the history keeps, per card, the last 50
rows and every row within 3600 s of the card's newest row, which is exactly
what the widest frames reach back to, so in-order data scores the same as in
batch.

Both outputs are append-only keyed tables: a batch writes its own alerts and the new
history of its own cards, and a replayed batch replaces exactly what it wrote, from
the history as of the batch before it: no duplicates, state unchanged.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import features as feat, skew
from ..operators.staging import dedup_latest, stg_transactions
from ..sources.keyed import KeyedTable

ALERT_THRESHOLD = 0.5
ALERT_SCHEMA = (
    "transaction_id string, card_id string, merchant_id string, amount double, event_ts timestamp,"
    " fraud_score double, is_alert boolean, event_date date")


#: Folders that card histories are dealt out to.
STATE_PARTS = 64


def alerts_table(spark: SparkSession, root: str) -> KeyedTable:
    """The serving table: the newest score of each transaction, filed by event date."""
    return KeyedTable(spark, root, "transaction_id", "event_date")


def serving_rows(scored: DataFrame, threshold: float) -> DataFrame:
    """Scored transactions as rows of the serving table."""
    return scored.select(
        F.col("transaction_id").cast("string"), F.col("card_id").cast("string"),
        F.col("merchant_id").cast("string"), F.col("amount_usd").alias("amount"), "event_ts",
        "fraud_score", (F.col("fraud_score") >= threshold).alias("is_alert"), F.to_date("event_ts").alias("event_date"))


def rule_score(feats: DataFrame) -> DataFrame:
    """Deterministic stand-in scorer (amount rule) for tests and dry runs."""
    return feats.withColumn("fraud_score", F.least(F.lit(1.0), F.col("amount_usd") / 300.0))


def model_score(model) -> Callable[[DataFrame], DataFrame]:
    """Score with a fitted MLlib PipelineModel whose input columns are the
    feature names; P(fraud) stays a JVM column (no collect to the driver)."""
    from pyspark.ml.functions import vector_to_array

    def fn(feats: DataFrame) -> DataFrame:
        filled = feats.fillna(0, subset=feat.FEATURES)
        out = model.transform(filled)
        return out.withColumn("fraud_score", vector_to_array("probability")[1]).drop(
            "features", "rawPrediction", "probability", "prediction")
    return fn


def bounded_history(rows: DataFrame, hot_card_rows: int = feat.HOT_CARD_ROWS) -> DataFrame:
    """Per card: the last ``AMOUNT_ROWS`` rows and all rows within the widest
    velocity window of the card's newest row.

    One shuffle by card.  Skew-safe: for cards with more rows than ``HOT_CARD_ROWS`` the
    newest epoch per card is a partial aggregate, the recent rows come from a join with
    it (AQE splits a hot card on the large side), and the last rows are an exact salted
    top-k.
    """
    rows = feat.with_epoch(rows).where("card_id is not null and epoch is not null")
    back = max(feat.VELOCITY_SECONDS)
    hot = skew.hot_keys(rows, feat.SPEC, hot_card_rows)
    cold, busy = (rows, None) if hot is None else skew.split_hot(rows, "card_id", hot)
    last_first = Window.partitionBy("card_id").orderBy(*[F.col(c).desc() for c in feat.ORDER])
    ranked = cold.withColumns({"_newest": F.first("epoch").over(last_first), "_rank": F.row_number().over(last_first)})
    kept = ranked.filter((F.col("epoch") >= F.col("_newest") - back) | (F.col("_rank") <= feat.AMOUNT_ROWS)).drop("_newest", "_rank")
    if busy is not None:
        newest = busy.groupBy("card_id").agg(F.max("epoch").alias("_newest"))
        recent = busy.join(newest, "card_id").filter(F.col("epoch") >= F.col("_newest") - back).drop("_newest")
        last = skew.top_k_per_key(busy, "card_id", list(feat.ORDER), feat.AMOUNT_ROWS)
        older = last.join(newest, "card_id").filter(F.col("epoch") < F.col("_newest") - back).drop("_newest")
        kept = kept.unionByName(recent).unionByName(older)
    return kept.drop("epoch")


class Scorer:
    """``foreachBatch`` handler: enrich, score, upsert alerts, refresh history."""

    def __init__(self, spark: SparkSession, cards: DataFrame, merchants: DataFrame, alerts_root: str,
                 state_root: str, score_fn: Callable[[DataFrame], DataFrame] = rule_score,
                 threshold: float = ALERT_THRESHOLD, raw_input: bool = True,
                 max_broadcast_rows: int = 5_000_000):
        self.spark, self.cards, self.merchants = spark, cards, merchants
        self.score_fn, self.threshold, self.raw_input = score_fn, threshold, raw_input
        # Dimension sizes are checked once; the micro-batch joins broadcast
        # them only below the bound, otherwise the planner decides.
        self.broadcast = (cards.count() <= max_broadcast_rows and merchants.count() <= max_broadcast_rows)
        self.alerts = alerts_table(spark, alerts_root)
        self.alerts.create_if_absent(ALERT_SCHEMA)
        # all rows of a card's newest batch are its history
        self.state = KeyedTable(spark, state_root, "card_id", "part", many=True)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        if batch_df.isEmpty():
            return
        batch = stg_transactions(batch_df) if self.raw_input else batch_df
        batch = batch.select(*feat.TXN_COLS).filter(F.col("event_ts").isNotNull())
        # the batch, and it with its history, are computed once, whoever reads them
        batch = dedup_latest(batch, "transaction_id", "event_ts").persist()
        inp = batch
        try:
            if self.state.exists():
                parts = [r[0] for r in batch.select(_part()).distinct().collect()]     # STATE_PARTS at most
                stored = self.state.read(int(batch_id) - 1).where(F.col("part").isin(parts)).drop("part")
                # rows that are delivered again, mostly few: the history itself isn't dealt out by id
                again = stored.select("transaction_id").join(batch.select("transaction_id"), "transaction_id", "left_semi").distinct()
                hist = (stored.join(batch.select("card_id").distinct(), "card_id", "left_semi")
                        .join(again, "transaction_id", "left_anti"))
                inp = batch.unionByName(hist, allowMissingColumns=True).persist()
            feats = feat.compute_features(inp, self.cards, self.merchants, broadcast_dims=self.broadcast)
            feats = feats.join(batch.select("transaction_id"), "transaction_id", "left_semi")
            self.alerts.append(serving_rows(self.score_fn(feats), self.threshold), int(batch_id))
            self.state.append(bounded_history(inp).withColumn("part", _part()), int(batch_id))
        finally:
            inp.unpersist()
            batch.unpersist()


def _part() -> Column:
    return F.pmod(F.xxhash64("card_id"), F.lit(STATE_PARTS)).cast("int").alias("part")


def start_scoring(spark: SparkSession, bronze_txn: str, schema: StructType, scorer: Scorer, checkpoint: str,
                  once: bool = True, processing_time: str = "10 seconds",
                  max_files_per_trigger: int | None = None,
                  view: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> StreamingQuery:
    """Stream new bronze transactions through the scorer; ``view`` makes raw
    transactions of the files' rows (the typed view of bronze lines)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    w = view(r.parquet(bronze_txn)).writeStream.foreachBatch(scorer).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=processing_time)
    return w.start()


def alert_flag(score: Column, threshold: float = ALERT_THRESHOLD) -> Column:
    return score >= threshold


def features_in_batches(txn: DataFrame, cards: DataFrame, merchants: DataFrame, batch_of: Column,
                        batches: list[int]) -> DataFrame:
    """Features computed the way the scorer computes them, one micro-batch at
    a time: batch ``k`` sees its own rows plus the bounded history of its cards
    from all earlier batches.  For data arriving in event-time order this
    equals the batch features (the parity the scorer relies on)."""
    t = txn.withColumn("_batch", batch_of)
    out = None
    for k in batches:
        batch = t.filter(F.col("_batch") == k).drop("_batch")
        prev = t.filter(F.col("_batch") < k).drop("_batch")
        hist = bounded_history(prev.join(batch.select("card_id").distinct(), "card_id", "left_semi"))
        f = feat.compute_features(batch.unionByName(hist), cards, merchants, broadcast_dims=False) \
            .join(batch.select("transaction_id"), "transaction_id", "left_semi")
        out = f if out is None else out.unionByName(f)
    return out
