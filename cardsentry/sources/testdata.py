"""Raw payment entities derived from the driver's benchmark tables.

The benchmark ships TPC-H-like tables plus an ``events`` table.  This module
maps them onto the pipeline's raw (bronze) entities with column expressions
only, so every derived table scales with its source and Catalyst prunes and
pushes down into the Parquet scans.  The DuckDB oracle in
``cardsentry.plans.oracle`` spells the same mapping in SQL.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import ensure_utc

# Fixed values of the mapping (merchant categories by s_suppkey % 12, in order).
CATEGORIES = [
    "grocery", "restaurant", "fuel", "online_retail", "electronics", "travel",
    "entertainment", "pharmacy", "apparel", "crypto_exchange", "gambling",
    "money_transfer",
]
# Fraud type by event_id % 5, in order.
FRAUD_TYPES = ["card_testing", "account_takeover", "geo_impossible",
               "amount_anomaly", "merchant_collusion"]
# Entry mode by event_type (anything else is 'online').
ENTRY_MODES = {"view": "chip", "click": "contactless", "signup": "swipe"}
HIGH_BASE_CATEGORY_CODES = [4, 9, 10, 11]
SNAPSHOT_1 = "2024-01-01 00:00:00"
SNAPSHOT_2 = "2024-01-15 00:00:00"
SNAPSHOT_3 = "2024-01-22 00:00:00"
# Columns whose change opens a new card version.
CARD_CHECK_COLS = ["is_active", "card_type", "home_country"]


_READS: dict[tuple[int, str], DataFrame] = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver tables are read-only: the (lazy) scan DataFrame is memoised per
    session so file listing and footer reads happen once per table."""
    ensure_utc(spark)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    hit = _READS.get(key)
    if hit is None or hit.sparkSession is not spark:   # ids can be reused by a new session
        hit = _READS[key] = spark.read.parquet(path)
    return hit


def _lookup(col: Column, values: list[str]) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(col == i, F.lit(v)) if expr is None else expr.when(col == i, F.lit(v))
    return expr


def _home_lat(key: Column) -> Column:
    return (F.lit(-50) + (key * 37) % 100).cast("double")


def _home_lon(key: Column) -> Column:
    return (F.lit(-120) + (key * 53) % 240).cast("double")


def _days(n: Column) -> Column:
    return F.make_dt_interval(n)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions: one per event."""
    ensure_utc(spark)
    ev = _read(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    fraud = (F.col("event_type") == "error") & (F.col("value") > 100)
    entry = F.lit("online")
    for k, v in reversed(list(ENTRY_MODES.items())):
        entry = F.when(F.col("event_type") == k, F.lit(v)).otherwise(entry)
    ts = F.col("ts").cast("timestamp")
    lat = _home_lat(uid) + F.when(fraud, F.lit(25.0)).otherwise((eid % 19 - 9).cast("double") / 100.0)
    lon = _home_lon(uid) + F.when(fraud, F.lit(40.0)).otherwise((eid % 23 - 11).cast("double") / 100.0)
    device = F.when(fraud | (eid % 33 == 0), F.concat(F.lit("X"), eid.cast("string"))) \
        .otherwise(F.concat(F.lit("D"), uid.cast("string")))
    return ev.select(
        eid.alias("transaction_id"),
        uid.alias("card_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("merchant_id"),
        F.col("value").alias("amount"),
        F.lit("USD").alias("currency"),
        ts.alias("ts"),
        F.to_date(ts).alias("event_date"),
        lat.alias("lat"),
        lon.alias("lon"),
        device.alias("device_id"),
        entry.alias("entry_mode"),
        fraud.alias("is_fraud"),
        F.when(fraud, _lookup(eid % 5, FRAUD_TYPES)).alias("fraud_type"),
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = _read(spark, sf_dir, "customer")
    na = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    # nation has a fixed 25 rows: broadcasting it is bounded at any scale.
    return cu.join(F.broadcast(na), cu.c_nationkey == na.n_nationkey, "left").select(
        k.alias("card_id"),
        F.floor(k / 2).cast("bigint").alias("account_id"),
        F.when(k % 2 == 0, F.lit("credit")).otherwise(F.lit("debit")).alias("card_type"),
        F.date_add(F.lit("2023-01-01").cast("date"), (k % 300).cast("int")).alias("issue_date"),
        F.concat(F.lit("D"), k.cast("string")).alias("primary_device_id"),
        _home_lat(k).alias("home_lat"),
        _home_lon(k).alias("home_lon"),
        F.col("n_name").alias("home_country"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = _read(spark, sf_dir, "customer")
    na = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    return (cu.filter(k % 2 == 0)
            .join(F.broadcast(na), cu.c_nationkey == na.n_nationkey, "left")
            .select(
                F.floor(k / 2).cast("bigint").alias("account_id"),
                F.date_add(F.lit("2022-01-01").cast("date"), (k % 365).cast("int")).alias("signup_date"),
                F.col("n_name").alias("home_country"),
                F.when(seg == "BUILDING", F.lit("high"))
                 .when(seg == "FURNITURE", F.lit("medium"))
                 .otherwise(F.lit("low")).alias("risk_band"),
            ))


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    su = _read(spark, sf_dir, "supplier")
    na = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("s_suppkey")
    base = F.when((k % 12).isin(HIGH_BASE_CATEGORY_CODES), F.lit(0.06)).otherwise(F.lit(0.004))
    return su.join(F.broadcast(na), su.s_nationkey == na.n_nationkey, "left").select(
        k.alias("merchant_id"),
        F.col("s_name").alias("name"),
        _lookup(k % 12, CATEGORIES).alias("category"),
        F.col("n_name").alias("country"),
        (F.lit(-40) + (k * 31) % 80).cast("double").alias("lat"),
        (F.lit(-100) + (k * 41) % 200).cast("double").alias("lon"),
        (base * (F.lit(5) + k % 14).cast("double") / 10.0).alias("baseline_fraud_rate"),
    )


def auth_events(spark: SparkSession, sf_dir: str, txn: DataFrame | None = None) -> DataFrame:
    t = txn if txn is not None else transactions(spark, sf_dir)
    tid, fraud = F.col("transaction_id"), F.col("is_fraud")
    approved = ~((fraud & (tid % 20 < 7)) | (~fraud & (tid % 100 < 3)))
    return t.filter(tid % 50 != 49).select(
        tid.alias("transaction_id"),
        approved.alias("approved"),
        F.when(approved, F.lit("approved")).when(fraud, F.lit("risk_block"))
         .otherwise(F.lit("do_not_honor")).alias("reason"),
        F.col("ts").alias("auth_ts"),
        F.col("event_date"),
    )


def chargebacks(spark: SparkSession, sf_dir: str, txn: DataFrame | None = None) -> DataFrame:
    t = txn if txn is not None else transactions(spark, sf_dir)
    tid, fraud = F.col("transaction_id"), F.col("is_fraud")
    settle = F.col("ts") + _days((F.lit(10) + tid % 36).cast("int"))
    return t.filter((fraud & (tid % 5 != 4)) | (~fraud & (tid % 625 == 0))).select(
        F.concat(F.lit("CB"), tid.cast("string")).alias("chargeback_id"),
        tid.alias("transaction_id"),
        F.col("amount"),
        F.when(fraud, F.lit("fraud")).otherwise(F.lit("dispute")).alias("reason_code"),
        settle.alias("settle_ts"),
        F.to_date(settle).alias("settle_date"),
    )


def live_fraud_alerts(spark: SparkSession, sf_dir: str, txn: DataFrame | None = None) -> DataFrame:
    """Serving-table rows scored with a fixed rule (score = min(1, amount/300))."""
    t = txn if txn is not None else transactions(spark, sf_dir)
    score = F.least(F.lit(1.0), F.col("amount") / 300.0)
    return t.select(
        "transaction_id", "card_id", "merchant_id", "amount",
        F.col("ts").alias("event_ts"),
        score.alias("fraud_score"),
        (score >= 0.5).alias("is_alert"),
    )


def card_snapshot(spark: SparkSession, sf_dir: str, which: int) -> DataFrame:
    """Card snapshots S1 (all cards) and S2 (flips, removals, device changes)."""
    c = cards(spark, sf_dir).select("card_id", "account_id", "card_type", "primary_device_id",
                                    "home_country", "is_active")
    if which == 1:
        return c
    k = F.col("card_id")
    return c.filter(k % 11 != 0).select(
        "card_id", "account_id",
        F.when(k % 13 == 0, F.when(F.col("card_type") == "credit", F.lit("debit")).otherwise(F.lit("credit")))
         .otherwise(F.col("card_type")).alias("card_type"),
        F.when(k % 17 == 0, F.concat(F.lit("N"), k.cast("string"))).otherwise(F.col("primary_device_id"))
         .alias("primary_device_id"),
        "home_country",
        F.when(k % 7 == 0, ~F.col("is_active")).otherwise(F.col("is_active")).alias("is_active"),
    )


def snapshot_ts(which: int) -> Column:
    return F.lit(SNAPSHOT_1 if which == 1 else SNAPSHOT_2).cast("timestamp")


class LazyTables(dict):
    """dict of DataFrames built on first access."""

    def __init__(self, builders):
        super().__init__()
        self._builders = builders

    def __missing__(self, key):
        self[key] = self._builders[key]()
        return self[key]

    def keys(self):
        return self._builders.keys()

    def items(self):
        return [(k, self[k]) for k in self._builders]

    def __iter__(self):
        return iter(self._builders)

    def __contains__(self, key):
        return key in self._builders

    def __len__(self):
        return len(self._builders)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t: LazyTables
    t = LazyTables({
        "transactions": lambda: transactions(spark, sf_dir),
        "auth_events": lambda: auth_events(spark, sf_dir, t["transactions"]),
        "chargebacks": lambda: chargebacks(spark, sf_dir, t["transactions"]),
        "accounts": lambda: accounts(spark, sf_dir),
        "cards": lambda: cards(spark, sf_dir),
        "merchants": lambda: merchants(spark, sf_dir),
    })
    return t
