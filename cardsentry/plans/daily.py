"""The daily job: what has arrived goes through silver and gold, nothing else does.

Each run is a batch.  It takes the bronze rows ingested since the last published run,
finds which days of which cards they touch (:mod:`cardsentry.operators.dirty`), reads
those and their context, recomputes their features and appends the changed fact rows.
Rows that only get a new outcome (authorisation, chargeback) keep their features.
Marts by date are recomputed for touched dates, the merchant mart from sums by date.

All tables are append-only (:mod:`cardsentry.sources.keyed`) and read up to the last
published batch.  A run publishes itself (one row in ``state/runs``) after the whole
quality gate has passed on what its tables would then show.  A run that fails leaves the published
tables as they are; the next attempt discards what it wrote.

What a run reads of the history: the id, card, time and date of transactions (one
narrow scan, bounded by the smallest and greatest arriving id, finds where redelivered
or referenced transactions are filed), the row counts by card and day as far back as
needed, chargebacks, and the dates it recomputes.  Card and merchant attributes in a
fact row are those of the run that computed it.
"""
from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.expr import MONEY, build_side, count_if, ratio
from ..operators import dirty, features as feat, gold, incremental, quality, scd2, staging
from ..session import ensure_utc, scratch_path
from ..sources import files
from ..sources.keyed import KeyedTable, overwrite_partitions
from ..sources.testdata import CARD_CHECK_COLS
from ..streaming import ingest as ing, scoring

#: Key and latest-wins column of the three bronze streams.
STREAM_KEYS = {"transactions": "transaction_id", "auth_events": "transaction_id", "chargebacks": "chargeback_id"}
RUNS = "batch long, topic string, upto timestamp, rows long"


@dataclass
class Warehouse:
    """The tables below a folder."""

    spark: SparkSession
    root: str

    def table(self, name: str, key, date: str = "event_date", many: bool = False, single: bool = False) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/{name}", key, date, many, single)

    def __post_init__(self) -> None:
        t = self.table
        self.transactions = t("silver/transactions", "transaction_id", single=True)
        self.auth_events = t("silver/auth_events", "transaction_id", "auth_date")
        self.auth_waiting = t("silver/auth_waiting", "transaction_id", "auth_date")
        self.chargebacks = t("silver/chargebacks", "chargeback_id", "settle_date")
        self.card_history = t("silver/card_history", ["card_id", scd2.VALID_FROM], "opened")
        self.fact = t("gold/fct_transactions", "transaction_id", single=True)
        self.by_hour = t("gold/agg_fraud_by_hour", "event_date", many=True)
        self.exposure = t("gold/mart_chargeback_exposure", "event_date", many=True)
        self.performance = t("gold/mart_model_performance", "event_date", many=True)
        self.merchant_days = t("gold/merchant_days", "event_date", many=True)
        # small tables that each run writes whole
        self.merchant_risk = t("gold/agg_merchant_risk", "part", "part", many=True)
        self.dim_merchant = t("gold/dim_merchant", "part", "part", many=True)
        self.dim_card = t("gold/dim_card", "part", "part", many=True)
        # changes of row counts: their rows add up, so none replaces another
        self.counts = t("silver/card_days", ["card_id", "day", "event_date"], "day")

    def tables(self) -> list[KeyedTable]:
        return [t for t in vars(self).values() if isinstance(t, KeyedTable)]

    def compact(self) -> None:
        at_once([t.compact for t in self.tables() if t is not self.counts])

    # ------------------------------------------------------------ runs
    def runs(self) -> DataFrame:
        path = f"{self.root}/state/runs"
        return self.spark.read.schema(RUNS).parquet(path) if files.exists(self.spark, path) else self.spark.createDataFrame([], RUNS)

    def published(self) -> int:
        """The last published batch; -1 before the first."""
        last = self.runs().agg(F.max("batch")).first()[0]
        return -1 if last is None else last

    def gold(self, name: str) -> DataFrame:
        """A published table: fct_transactions, dim_merchant, dim_card or a mart."""
        tables = {"fct_transactions": self.fact, "agg_fraud_by_hour": self.by_hour, "mart_chargeback_exposure": self.exposure, "mart_model_performance": self.performance,
                  "agg_merchant_risk": self.merchant_risk, "dim_merchant": self.dim_merchant, "dim_card": self.dim_card, "card_history": self.card_history}
        return tables[name].read(self.published()).drop("part", "opened")

    def alerts(self) -> DataFrame:
        """The streaming scorer's serving table; no rows before it has begun."""
        table = scoring.alerts_table(self.spark, f"{self.root}/gold/live_fraud_alerts")
        table.create_if_absent(scoring.ALERT_SCHEMA)
        return table.read()

    def quarantine(self, topic: str) -> DataFrame:
        """Bad lines and values of the wrong type that runs have put aside."""
        return self.spark.read.schema("reason string, field string, value string, _ingest_ts timestamp, _source_file string, batch int").parquet(f"{self.root}/quarantine/{topic}")

    def card_days(self) -> DataFrame:
        """(card_id, day, event_date, n) summed over the runs so far."""
        return self.counts.since(0).groupBy("card_id", "day", "event_date").agg(F.sum("n").alias("n")).where("n <> 0")


def at_once(steps: list) -> None:
    """Run steps that don't depend on each other beside one another; the first error is raised."""
    with ThreadPoolExecutor(6) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


def kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: computed once, whoever reads it."""
    path = scratch_path(df.sparkSession, f"daily-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- arrivals
def arrivals(spark: SparkSession, wh: Warehouse, topic: str) -> tuple[DataFrame, DataFrame]:
    """(raw, staged) bronze rows of a stream after its high-water mark, staged ones
    reduced to the latest delivery of each key.  The mark reaches the files' statistics."""
    raw = ing.read_topic(spark, f"{wh.root}/bronze", topic)
    mark = incremental.high_water_mark(wh.runs().where(F.col("topic") == topic), "upto")
    new = raw.where(F.col("_ingest_ts") > mark.cast("timestamp"))
    latest = staging.dedup_latest(new.drop("_rescued"), STREAM_KEYS[topic], "_ingest_ts")
    return new, staging.silver({topic: latest})[topic]


def unchanged(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` that differ from ``old`` in some column, or aren't there."""
    return new.alias("n").join(old.hint("merge").alias("o"), dirty.same("n", "o", *new.columns) & (F.col(f"n.{key}") == F.col(f"o.{key}")), "left_anti")


def repeated(rows: DataFrame, key: str) -> DataFrame | None:
    """The keys that several of these stored rows have; None if there are none."""
    twice = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key)
    return None if twice.isEmpty() else kept(twice, "twice")


def single_rows(rows: DataFrame, key: str, twice: DataFrame | None, date: str = "event_date") -> DataFrame:
    """One row of each key: of those that have a key of ``twice`` the greatest, in the
    order in which a table's columns are read (the date comes last)."""
    if twice is None:
        return rows
    side = build_side(twice)
    several = rows.join(side, key, "left_semi").select(*[c for c in rows.columns if c != date], date)
    return rows.join(side, key, "left_anti").select(*rows.columns).unionByName(staging.dedup_latest(several, key, []))


def found_at(table: KeyedTable, before: int, ids: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Where the rows with these ids are filed: a scan of ``columns`` only, between the smallest and the greatest id."""
    lo, hi = ids.agg(F.min(key), F.max(key)).first()
    rows = table.read(before).select(key, *columns)
    return kept(rows.where(F.col(key).between(lo, hi)).join(build_side(ids), key, "left_semi"), "found")


def dates_of(rows: DataFrame, column: str = "event_date") -> list:
    """The different dates of some rows: at most one for each day of the history."""
    return [r[0] for r in rows.select(column).distinct().collect()]


def on_dates(rows: DataFrame, dates: list, column: str = "event_date"):
    """The rows on these dates, as a filter of literals that prunes partitions."""
    named = [d for d in dates if d is not None]
    test = F.col(column).isin(named) if named else F.lit(False)
    return rows.where(test | F.col(column).isNull() if None in dates else test)


def put_aside(wh: Warehouse, topic: str, batch: int) -> None:
    """The batch's bad lines and values of the wrong type, as rows of ``quarantine/<topic>``."""
    path = f"{wh.root}/bronze/raw_{topic}"
    mark = incremental.high_water_mark(wh.runs().where(F.col("topic") == topic), "upto")
    new = ing.read_raw(wh.spark, path).where(F.col("_ingest_ts") > mark.cast("timestamp"))
    rows = ing.quarantine(new, ing.stored_schema(wh.spark, path, files.TOPICS[topic]))
    overwrite_partitions(rows.withColumn("batch", F.lit(batch)), f"{wh.root}/quarantine/{topic}", "batch")


# ---------------------------------------------------------------- fact
def update_fact(wh: Warehouse, batch: int, new: dict[str, DataFrame], cards: DataFrame, merchants: DataFrame,
                hot_card_rows: int | None = feat.HOT_CARD_ROWS) -> list:
    """Append the fact rows that the staged arrivals change; returns the touched dates.

    The silver tables, the card counts and the fact get this batch's rows; the state
    read is that of the batch before.  Rows without transaction_id stay in silver for
    the gate to count: they can't be identified again, so they have no fact row.
    """
    spark, before = wh.spark, batch - 1
    first = batch == 0 or not wh.transactions.exists()
    txn, auth, cb = (kept(new[t], t) for t in ("transactions", "auth_events", "chargebacks"))
    auth = auth.withColumn("auth_date", F.to_date("auth_ts"))

    # where the transactions that arrive again, or are referred to, are filed
    old_cb = wh.chargebacks.read(before).join(build_side(cb.select("chargeback_id")), "chargeback_id", "left_semi") if not first else cb.limit(0)
    disputed = kept(cb.select("transaction_id").unionByName(old_cb.select("transaction_id")).where("transaction_id is not null").distinct(), "disputed")
    ids = txn.select("transaction_id").unionByName(auth.select("transaction_id")).unionByName(disputed).where("transaction_id is not null").distinct()
    place = ["card_id", "event_ts", "event_date"]
    known = found_at(wh.transactions, before, kept(ids, "ids"), "transaction_id", place) if not first else txn.limit(0).select("transaction_id", *place)
    txn_ids = build_side(txn.select("transaction_id"))
    if first:
        changed, left = txn, None
    else:
        old = on_dates(wh.transactions.read(before), dates_of(known.join(txn_ids, "transaction_id", "left_semi")))
        changed = kept(unchanged(txn, old.select(*txn.columns), "transaction_id"), "changed")
        left = kept(known.join(build_side(changed.select("transaction_id")), "transaction_id", "left_semi"), "left")
    # the table gets one row of a key; card counts count what came, repeated rows too
    own = single_rows(changed, "transaction_id", repeated(changed, "transaction_id"))

    waiting = auth.join(build_side(known.select("transaction_id")), "transaction_id", "left_anti").join(txn_ids, "transaction_id", "left_anti")
    with_id = changed.where("transaction_id is not null")
    at_once([partial(wh.transactions.append, own, batch, replaces=left), partial(wh.auth_events.append, auth, batch), partial(wh.chargebacks.append, cb, batch),
             partial(wh.auth_waiting.append, waiting, batch), lambda: wh.counts.append(dirty.count_changes(with_id, left), batch)])

    # days to read and rows to recompute
    silver = wh.transactions.read(batch).where("transaction_id is not null")
    if first:
        rows = feat.compute_features(silver, cards, merchants, hot_card_rows=hot_card_rows)
    else:
        places = with_id.select(*place) if left is None else with_id.select(*place).unionByName(left.select(*place))
        marks = kept(dirty.markers(places), "marks")
        counts = kept(dirty.touched_counts(wh.card_days(), marks), "counts")
        days = kept(dirty.needed_days(counts, marks), "days")
        wanted = build_side(days)
        folders = dates_of(counts.alias("c").join(wanted.alias("d"), dirty.same("c", "d", "card_id", "day"), "left_semi"))
        pruned = on_dates(silver, folders).withColumn("day", F.to_date("event_ts"))
        history = kept(pruned.alias("t").join(wanted.alias("d"), dirty.same("t", "d", "card_id", "day")).select("t.*", "d.dirty"), "history")
        rows = feat.compute_features(history, cards, merchants, hot_card_rows=hot_card_rows, keep=("dirty",)).where("dirty").drop("dirty")

    # outcomes: what has just come, else what the fact row had, else what waited for the transaction
    rows = kept(rows, "features")
    if not first:
        said = kept(known.join(build_side(auth.select("transaction_id").unionByName(disputed)), "transaction_id", "left_semi"), "said")
        only = on_dates(wh.fact.read(before), dates_of(said)).join(build_side(said.select("transaction_id")), "transaction_id", "left_semi")
        only = only.join(build_side(rows.select("transaction_id")), "transaction_id", "left_anti").select(*feat.OUTPUT_COLS)
        rows = rows.unionByName(kept(only, "only"))
        where = dates_of(rows.select("event_date").unionByName(left.select("event_date")))
        was = on_dates(wh.fact.read(before), where).select("transaction_id", "is_approved", "decline_reason", F.lit(1).alias("rank"))
    else:
        was = auth.limit(0).select("transaction_id", "is_approved", "decline_reason", F.lit(1).alias("rank"))
    answer = ["transaction_id", "is_approved", "decline_reason"]
    told = auth.select(*answer, F.lit(2).alias("rank")).unionByName(was).unionByName(wh.auth_waiting.read(before).select(*answer, F.lit(0).alias("rank")) if not first else was.limit(0))
    row_ids = build_side(rows.select("transaction_id"))
    told = staging.dedup_latest(told.join(row_ids, "transaction_id", "left_semi"), "transaction_id", "rank").drop("rank")
    claims = wh.chargebacks.read(batch).join(row_ids, "transaction_id", "left_semi")
    fact = gold.fct_transactions(rows, told.hint("merge"), claims.hint("merge"))
    # a fact row of a transaction that was there before may replace one; repeated dimension keys repeat rows
    replaces = None
    if left is not None:
        added = kept(with_id.select("transaction_id").join(build_side(left.select("transaction_id")), "transaction_id", "left_anti"), "added")
        replaces = rows.select("transaction_id").distinct().join(build_side(added), "transaction_id", "left_anti")
    wh.fact.append(single_rows(fact, "transaction_id", repeated(rows, "transaction_id")), batch, replaces=replaces)
    touched = wh.fact.since(batch).select("event_date")
    return dates_of(touched if left is None else touched.unionByName(left.select("event_date")))


def merchant_days(fact: DataFrame) -> DataFrame:
    """Sums by date and merchant that add up to the merchant mart."""
    fraud, cb, money = F.col("is_fraud_label"), F.col("is_confirmed_fraud"), F.col("amount_usd").cast(MONEY)
    return fact.groupBy("event_date", "merchant_id").agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum(money).alias("gmv"), count_if(fraud).alias("fraud_count"),
        F.sum(F.when(cb, money).otherwise(F.lit(0).cast(MONEY))).alias("chargeback"))


def merchant_risk(days: DataFrame, dim: DataFrame) -> DataFrame:
    """The merchant mart from its sums by date."""
    per = days.groupBy("merchant_id").agg(F.sum("txn_count").alias("txn_count"), F.sum("gmv").cast("double").alias("gmv_usd"),
                                          F.sum("fraud_count").alias("fraud_count"), F.sum("chargeback").cast("double").alias("chargeback_usd"))
    return per.join(dim, "merchant_id").select(
        "merchant_id", "merchant_name", "merchant_category", "risk_tier", "baseline_fraud_rate", "txn_count", "gmv_usd", "fraud_count",
        F.round(ratio(F.col("fraud_count"), F.col("txn_count")), 4).alias("observed_fraud_rate"), "chargeback_usd")


def update_marts(wh: Warehouse, batch: int, touched: list, silver: dict[str, DataFrame]) -> None:
    """Marts by date for the touched dates, and the small tables whole."""
    fact, part = on_dates(wh.fact.read(batch), touched), F.lit(0).alias("part")
    dim = gold.dim_merchant(silver["merchants"])
    at_once([
        lambda: wh.by_hour.append(gold.agg_fraud_by_hour(fact), batch),
        lambda: wh.exposure.append(gold.mart_chargeback_exposure(fact), batch),
        lambda: wh.merchant_days.append(merchant_days(fact), batch),
        lambda: wh.dim_merchant.append(dim.select("*", part), batch),
        lambda: wh.dim_card.append(gold.dim_card(wh.card_history.read(batch), silver["accounts"]).select("*", part), batch),
        # scores may come at any time for any date
        lambda: wh.performance.append(gold.mart_model_performance(wh.fact.read(batch), wh.alerts()), batch),
    ])
    if empty := sorted(set(touched) - set(dates_of(fact)), key=str):
        for t in (wh.by_hour, wh.exposure, wh.merchant_days):
            t.forget(empty)
    wh.merchant_risk.append(merchant_risk(wh.merchant_days.read(batch), dim).select("*", part), batch)


def update_card_history(wh: Warehouse, batch: int, cards: DataFrame, as_of) -> None:
    """Append the card versions that this snapshot closes and opens."""
    cols = ["card_id", "account_id", "card_type", "primary_device_id", "home_country", "is_active"]
    t = F.lit(as_of).cast("timestamp")
    have = wh.card_history.exists()
    current = wh.card_history.read(batch - 1).where(F.col(scd2.VALID_TO).isNull()).drop("opened") if have else None
    step = scd2.scd2_apply(current, cards.select(*cols), "card_id", CARD_CHECK_COLS, as_of)
    changed = step.where((F.col(scd2.VALID_FROM) == t) | (F.col(scd2.VALID_TO) == t))
    wh.card_history.append(changed.withColumn("opened", F.to_date(scd2.VALID_FROM)), batch)


# ---------------------------------------------------------------- gate
def gate(wh: Warehouse, batch: int, raw: dict[str, DataFrame], silver: dict[str, DataFrame]) -> None:
    """All schema checks and invariants over what the run would publish; a failed
    check, or one whose table is absent, stops the run.  The results are in
    ``quality/runs``, the rows that failed row-level checks reject in
    ``quarantine/checks``."""
    spark, fact = wh.spark, wh.fact.read(batch)
    tables = {f"raw_{k}": v for k, v in raw.items()} | {f"stg_{k}": v for k, v in silver.items()} | {
        "fct_transactions": fact, "dim_merchant": wh.dim_merchant.read(batch), "dim_card": wh.dim_card.read(batch),
        "agg_fraud_by_hour": wh.by_hour.read(batch), "agg_merchant_risk": wh.merchant_risk.read(batch), "mart_model_performance": wh.performance.read(batch)}
    checks, mark = quality.default_checks(), F.lit(batch)
    overwrite_partitions(quality.run_suite(tables, checks, quality.invariants(silver, fact)).withColumn("batch", mark), f"{wh.root}/quality/runs", "batch")
    result = spark.read.parquet(f"{wh.root}/quality/runs").where(F.col("batch") == batch)
    failed = {r[0] for r in result.where("status = 'fail'").select("check_name").collect()}     # one name a check
    broken = [c for c in checks if c.name in failed and c.kind in quality.ROW_KINDS]
    if broken:
        overwrite_partitions(quality.violating_rows(tables, broken).withColumn("batch", mark), f"{wh.root}/quarantine/checks", "batch")
    quality.assert_suite(result)


def daily_build(spark: SparkSession, landing: str, warehouse: str, checkpoints: str, run_quality: bool = True,
                hot_card_rows: int | None = feat.HOT_CARD_ROWS, as_of: str | None = None, compact: bool = True) -> dict[str, int]:
    """Ingest, update silver and gold by what has arrived, check, publish.

    ``as_of``: time of the card snapshot, and of the freshness check, which only runs
    when it is given; without it the snapshot's ingestion time is taken.
    Returns the rows that each table got.  A run without arrivals still refreshes the
    small tables.
    """
    ensure_utc(spark)
    wh = Warehouse(spark, warehouse)
    ing.ingest_all(spark, landing, f"{warehouse}/bronze", checkpoints)
    batch = wh.published() + 1
    at_once([partial(t.discard, batch) for t in wh.tables()])
    raw = {t: ing.read_topic(spark, f"{warehouse}/bronze", t) for t in [*files.TOPICS, *files.REFERENCE]}
    if as_of is not None:
        check_freshness(wh, raw, as_of, batch)
    new = {t: arrivals(spark, wh, t) for t in files.TOPICS}
    upto = {t: r.agg(F.max("_ingest_ts"), F.count(F.lit(1))).first() for t, (r, _) in new.items()}
    at_once([partial(put_aside, wh, t, batch) for t in files.TOPICS])
    dims = staging.silver({t: raw[t] for t in files.REFERENCE})
    touched = update_fact(wh, batch, {t: s for t, (_, s) in new.items()}, dims["cards"], dims["merchants"], hot_card_rows)
    when = as_of or raw["cards"].agg(F.max("_ingest_ts")).first()[0]
    update_card_history(wh, batch, dims["cards"], when)
    update_marts(wh, batch, touched, dims)
    silver = {**{t: dims[t] for t in files.REFERENCE}, "transactions": wh.transactions.read(batch),
              "auth_events": wh.auth_events.read(batch), "chargebacks": wh.chargebacks.read(batch)}
    if run_quality:
        gate(wh, batch, raw, silver)
    rows = [(batch, t, mark, n) for t, (mark, n) in upto.items()]
    spark.createDataFrame(rows, RUNS).coalesce(1).write.mode("append").parquet(f"{warehouse}/state/runs")
    if compact:
        wh.compact()
    return {t: n for t, (_, n) in upto.items()} | {"fct_transactions": wh.gold("fct_transactions").count()}


def check_freshness(wh: Warehouse, raw: dict[str, DataFrame], as_of: str, batch: int, warn_after_hours: float = 12, error_after_hours: float = 24) -> None:
    """Record the freshness of every bronze table; one past its error threshold stops the run."""
    parts = [quality.freshness(df, "_ingest_ts", as_of, warn_after_hours, error_after_hours, table=f"raw_{t}") for t, df in raw.items()]
    path = f"{wh.root}/quality/freshness"
    overwrite_partitions(quality.union_all(parts).withColumn("batch", F.lit(batch)), path, "batch")
    stale = wh.spark.read.parquet(path).where((F.col("batch") == batch) & (F.col("status") == "error")).take(10)
    if stale:
        raise RuntimeError(f"stale sources: {[r['table_name'] for r in stale]}")
