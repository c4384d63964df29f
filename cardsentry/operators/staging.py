"""Silver layer: typed, renamed 1:1 projections of the bronze tables.

Casts use ``try_cast`` so a malformed value becomes NULL instead of failing
the whole job under ANSI mode; ``rejects`` counts such rows per column.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _tc(name: str, typ: str):
    return F.col(name).try_cast(typ)


def stg_transactions(raw: DataFrame) -> DataFrame:
    return raw.select(
        "transaction_id", "card_id", "merchant_id",
        _tc("amount", "double").alias("amount_usd"),
        "currency",
        _tc("ts", "timestamp").alias("event_ts"),
        _tc("event_date", "date").alias("event_date"),
        _tc("lat", "double").alias("lat"),
        _tc("lon", "double").alias("lon"),
        "device_id", "entry_mode",
        _tc("is_fraud", "boolean").alias("is_fraud_label"),
        F.col("fraud_type").alias("fraud_type_label"),
    )


def stg_auth_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "transaction_id",
        _tc("approved", "boolean").alias("is_approved"),
        F.col("reason").alias("decline_reason"),
        _tc("auth_ts", "timestamp").alias("auth_ts"),
    )


def stg_chargebacks(raw: DataFrame) -> DataFrame:
    return raw.select(
        "chargeback_id", "transaction_id",
        _tc("amount", "double").alias("chargeback_amount"),
        "reason_code",
        _tc("settle_ts", "timestamp").alias("settle_ts"),
        _tc("settle_date", "date").alias("settle_date"),
    )


def stg_accounts(raw: DataFrame) -> DataFrame:
    return raw.select("account_id", _tc("signup_date", "date").alias("signup_date"),
                      "home_country", "risk_band")


def stg_cards(raw: DataFrame) -> DataFrame:
    return raw.select(
        "card_id", "account_id", "card_type",
        _tc("issue_date", "date").alias("issue_date"),
        "primary_device_id",
        _tc("home_lat", "double").alias("home_lat"),
        _tc("home_lon", "double").alias("home_lon"),
        "home_country",
        _tc("is_active", "boolean").alias("is_active"),
    )


def stg_merchants(raw: DataFrame) -> DataFrame:
    return raw.select(
        "merchant_id",
        F.col("name").alias("merchant_name"),
        F.col("category").alias("merchant_category"),
        F.col("country").alias("merchant_country"),
        _tc("lat", "double").alias("lat"),
        _tc("lon", "double").alias("lon"),
        _tc("baseline_fraud_rate", "double").alias("baseline_fraud_rate"),
    )


def dedup_latest(df: DataFrame, key: str | list[str], order_desc: str | list[str]) -> DataFrame:
    """Keep one row per key: the greatest by ``order_desc`` (NULLs lowest),
    remaining ties broken by the other columns, so the choice is deterministic.

    Written as an aggregate (``max`` over a struct whose leading fields are
    the order columns and whose remaining fields are the row), not as a
    ``row_number`` window: partial aggregation keeps one row per key per task
    before the shuffle, so a key delivered millions of times does not end up
    whole in one task.  A row with a NULL in its key is no duplicate of any
    other: each stays, for the not_null checks to count.
    """
    keys = [key] if isinstance(key, str) else list(key)
    orders = [order_desc] if isinstance(order_desc, str) else list(order_desc)
    rest = [c for c in df.columns if c not in keys and c not in orders]
    best = F.max(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(orders)],
                          *[F.col(c).alias(f"_r{i}") for i, c in enumerate(rest)])).alias("_best")
    keyless = F.lit(False)
    for k in keys:
        keyless = keyless | F.col(k).isNull()
    alone = df.withColumn("_alone", F.when(keyless, F.monotonically_increasing_id()))
    out = alone.groupBy(*keys, "_alone").agg(best)
    names = {**{f"_o{i}": c for i, c in enumerate(orders)}, **{f"_r{i}": c for i, c in enumerate(rest)}}
    return out.select(*keys, *[F.col(f"_best.{k}").alias(v) for k, v in names.items()]).select(*df.columns)


def rejects(raw: DataFrame, casts: dict[str, str]) -> DataFrame:
    """One row: per raw column, how many present values fail the cast to the
    given type (they become NULL in silver instead of failing the job)."""
    return raw.agg(*[
        F.sum(F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), 1).otherwise(0))
         .cast("bigint").alias(f"{c}_rejects")
        for c, t in casts.items()])


# Casts applied by stg_transactions, for reject counting.
TRANSACTION_CASTS = {"amount": "double", "ts": "timestamp", "event_date": "date", "lat": "double",
                     "lon": "double", "is_fraud": "boolean"}


def silver(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage every bronze table present in ``raw``."""
    fns = {
        "transactions": stg_transactions, "auth_events": stg_auth_events,
        "chargebacks": stg_chargebacks, "accounts": stg_accounts,
        "cards": stg_cards, "merchants": stg_merchants,
    }
    from ..sources.testdata import LazyTables
    return LazyTables({k: (lambda k=k: fns[k](raw[k])) for k in raw.keys() if k in fns})
