"""Whole-table checks of what jobs write: each entry sends the tables through a job's
own sources, sinks and tables in a scratch folder and returns what a reader then sees."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..operators import gold
from ..session import scratch_path
from ..sources import files
from ..sources.keyed import KeyedTable
from ..streaming import ingest as ing, scoring
from . import daily
from .catalog import register
from .context import Pipeline, ntz, report_rounded
from .oracle import q
from .queries_core import _sql_feats

CUTOFF = "2024-01-20 00:00:00"
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _folder(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# ---------------------------------------------------------------- daily job
def _deliveries(p: Pipeline) -> list[dict[str, DataFrame]]:
    """Three runs: what there was by the cutoff without every 97th transaction, the
    rest without those, and the late ones; labels by their own times."""
    s, cut = p.silver, F.lit(CUTOFF).cast("timestamp")
    late = F.col("transaction_id") % 97 == 0
    txn, auth, cb = s["transactions"], s["auth_events"], s["chargebacks"]
    return [
        {"transactions": txn.where((F.col("event_ts") < cut) & ~late), "auth_events": auth.where(F.col("auth_ts") < cut), "chargebacks": cb.where(F.col("settle_ts") < cut)},
        {"transactions": txn.where((F.col("event_ts") >= cut) & ~late), "auth_events": auth.where(F.col("auth_ts") >= cut), "chargebacks": cb.where(F.col("settle_ts") >= cut)},
        {"transactions": txn.where(late), "auth_events": auth.limit(0), "chargebacks": cb.limit(0)},
    ]


def _run(spark, sf_dir, each=lambda wh, batch, touched: None) -> daily.Warehouse:
    p = Pipeline.get(spark, sf_dir)
    wh = daily.Warehouse(spark, _folder(spark, "daily"))
    cards, merchants = p.dims
    for batch, new in enumerate(_deliveries(p)):
        touched = daily.update_fact(wh, batch, new, cards, merchants)
        each(wh, batch, touched)
    return wh


@register("pipe_01_daily_fact", q(f"SELECT {_sql_feats(gold.FACT_COLS)} FROM fct_transactions"))
def pipe_01(spark, sf_dir):
    """The fact after three daily runs (late transactions, authorisations that came
    before them and late chargebacks among them) equals a full rebuild."""
    return report_rounded(_run(spark, sf_dir).fact.read())


@register("src_14_incremental_marts", q("SELECT * FROM agg_merchant_risk"))
def src_14(spark, sf_dir):
    """The merchant mart from sums by date, of which each run writes the touched dates."""
    p = Pipeline.get(spark, sf_dir)
    wh = _run(spark, sf_dir, lambda wh, batch, touched: wh.merchant_days.append(daily.merchant_days(daily.on_dates(wh.fact.read(batch), touched)), batch))
    return daily.merchant_risk(wh.merchant_days.read(), p.dim_merchant)


# ---------------------------------------------------------------- append-only tables
_SERVED = """
, sent AS (
  SELECT transaction_id, card_id, event_ts, CAST(event_ts AS DATE) AS event_date, amount, 0 AS batch FROM live_fraud_alerts WHERE transaction_id % 4 <> 3
  UNION ALL SELECT transaction_id, card_id, event_ts, CAST(CASE WHEN transaction_id % 7 = 0 THEN event_ts + INTERVAL 1 DAY ELSE event_ts END AS DATE), amount + 1, 1 FROM live_fraud_alerts WHERE transaction_id % 3 = 0
  UNION ALL SELECT transaction_id, card_id, event_ts, CAST(event_ts AS DATE), amount + 2, 2 FROM live_fraud_alerts WHERE transaction_id % 5 = 0)
SELECT transaction_id, card_id, event_ts, event_date, amount FROM sent
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY batch DESC) = 1"""


@register("str_05_append_sink", q(_SERVED))
def str_05(spark, sf_dir):
    """Three batches into the serving table, the second one twice and with rows whose
    date moves; compacted in between.  A reader sees the newest row of each key."""
    a = Pipeline.get(spark, sf_dir).alerts.select("transaction_id", "card_id", "event_ts", F.to_date("event_ts").alias("event_date"), "amount")
    tid = F.col("transaction_id")
    moved = F.when(tid % 7 == 0, F.date_add("event_date", 1)).otherwise(F.col("event_date"))
    batches = [a.where(tid % 4 != 3), a.where(tid % 3 == 0).withColumns({"event_date": moved, "amount": F.col("amount") + 1}), a.where(tid % 5 == 0).withColumn("amount", F.col("amount") + 2)]
    table = KeyedTable(spark, _folder(spark, "serving"), "transaction_id")
    for batch, rows in enumerate(batches):
        table.append(rows, batch)
        if batch == 1:
            table.append(rows, batch)
            table.compact()
    return ntz(table.read())


@register("str_08_replayed_scores", q("SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, amount, fraud_score, is_alert, CAST(event_ts AS DATE) AS event_date FROM live_fraud_alerts"))
def str_08(spark, sf_dir):
    """All transactions through the foreachBatch scorer in four batches, the third one
    twice (a replay): one score for each, as of the batch job's rule."""
    p = Pipeline.get(spark, sf_dir)
    root = _folder(spark, "scorer")
    scorer = scoring.Scorer(spark, p.silver["cards"], p.silver["merchants"], f"{root}/alerts", f"{root}/state", raw_input=False)
    txn, part = p.silver["transactions"], F.floor((F.dayofmonth("event_ts") - 1) / 8)
    for batch, k in enumerate([0, 1, 2, 3]):
        scorer(txn.where(part == k), batch)
        if k == 2:
            scorer(txn.where(part == k), batch)
    return scorer.alerts.read().select("transaction_id", "amount", "fraud_score", "is_alert", "event_date")


# ---------------------------------------------------------------- files
def _lines(p: Pipeline) -> DataFrame:
    """Raw transactions as JSON lines: every 7th has one more field, every 11th an
    amount that is no number, and every 13th line is cut off."""
    t, tid = p.raw["transactions"], F.col("transaction_id")
    row = F.struct("transaction_id", "card_id", F.date_format("ts", ISO).alias("ts"), F.when(tid % 11 != 0, F.col("amount")).alias("amount"))
    plain = F.to_json(row)
    plain = F.when(tid % 11 == 0, F.concat(F.substring(plain, 1, F.length(plain) - 1), F.lit(',"amount":"n/a"}'))).otherwise(plain)
    wide = F.when(tid % 7 == 0, F.concat(F.substring(plain, 1, F.length(plain) - 1), F.lit(',"channel":"app"}'))).otherwise(plain)
    return t.select("event_date", F.when(tid % 13 == 0, F.substring(wide, 1, F.length(wide) - 1)).otherwise(wide).alias("value"), (tid % 2 == 0).alias("first"))


_BRONZE = "transaction_id bigint, card_id bigint, ts timestamp, amount double, event_date date"


def _ingested(spark, sf_dir, widen: bool) -> str:
    """The lines in two deliveries, by date folders, through the ingest stream."""
    lines = _lines(Pipeline.get(spark, sf_dir))
    root = _folder(spark, "ingest")
    path = f"{root}/bronze"
    for first in (True, False):
        lines.where(F.col("first") == first).drop("first").repartition("event_date").write.mode("append").partitionBy("event_date").text(f"{root}/landing")
        ing.ingest(spark, f"{root}/landing", path, f"{root}/ck").awaitTermination()
        if widen:
            ing.evolve(spark, path, _BRONZE)
    return path


@register("src_04_evolution_without_loss", q("""
SELECT transaction_id, card_id, ts, CASE WHEN transaction_id % 11 <> 0 THEN amount END AS amount, event_date,
       CASE WHEN transaction_id % 7 = 0 THEN 'app' END AS channel, CASE WHEN transaction_id % 11 = 0 THEN '{"amount":"n/a"}' END AS rescued
FROM raw_transactions WHERE transaction_id % 13 <> 0"""))
def src_04(spark, sf_dir):
    """Files with a field that the schema doesn't know, wrong types and broken lines:
    the typed view after the stored schema has been widened, with what didn't fit."""
    path = _ingested(spark, sf_dir, widen=True)
    return ntz(ing.read_bronze(spark, path).select("transaction_id", "card_id", "ts", "amount", "event_date", "channel", F.col("_rescued").alias("rescued")))


@register("src_04b_quarantine", q("""
SELECT 'line' AS reason, count(*) AS n FROM raw_transactions WHERE transaction_id % 13 = 0
UNION ALL SELECT 'type', count(*) FROM raw_transactions WHERE transaction_id % 13 <> 0 AND transaction_id % 11 = 0"""))
def src_04b(spark, sf_dir):
    """Broken lines and values of the wrong type, put aside with their text."""
    path = _ingested(spark, sf_dir, widen=False)
    aside = ing.quarantine(ing.read_raw(spark, path), files.schema_of(spark, _BRONZE))
    return aside.where((F.col("reason") == "type") & (F.col("value") == "n/a") | (F.col("reason") == "line") & F.col("value").startswith("{")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register("src_10_jsonl_round_trip", q("SELECT transaction_id, card_id, amount, device_id, event_date FROM raw_transactions"))
def src_10(spark, sf_dir):
    """Date-partitioned JSON lines written, replaced and read back with their partition column."""
    rows = Pipeline.get(spark, sf_dir).raw["transactions"].select("transaction_id", "card_id", "amount", "device_id", "event_date")
    path = _folder(spark, "jsonl")
    for _ in range(2):
        files.write_partitioned_jsonl(rows, path)
    return files.read_jsonl_dataset(spark, path).select("transaction_id", "card_id", "amount", "device_id", "event_date")
