"""Rule detectors for the documented fraud signals, over feature rows.

Thresholds are parameters (defaults derived from the signal descriptions:
tiny online charges seconds apart, unknown device far from home with an amount
spike, faster-than-jet travel, extreme amount z-scores, bursts at high-risk
merchants).  Bursts are counted by (key, second) first and then over the distinct
seconds in slices of time (:mod:`cardsentry.operators.skew`), whatever the key's rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import skew

# Default rule thresholds.
TESTING_MAX_AMOUNT = 5.0
TESTING_WINDOW_S = 60
TESTING_MIN_COUNT = 2
TAKEOVER_MIN_KM = 500.0
TAKEOVER_MIN_Z = 2.0
JET_SPEED_KMH = 900.0
ANOMALY_MIN_Z = 4.0
COLLUSION_WINDOW_S = 3600
COLLUSION_MIN_COUNT = 3
HIGH_RISK_TIER = "high"


def _epoch(df: DataFrame) -> DataFrame:
    return df if "epoch" in df.columns else df.withColumn("epoch", F.unix_timestamp("event_ts"))


def card_testing(feats: DataFrame, max_amount: float = TESTING_MAX_AMOUNT, window_s: int = TESTING_WINDOW_S,
                 min_count: int = TESTING_MIN_COUNT, slice_seconds: int = skew.SLICE_SECONDS) -> DataFrame:
    """Small online charges with at least ``min_count`` such charges on the
    card within the trailing ``window_s`` seconds (same second included)."""
    small = _epoch(feats.filter((F.col("entry_mode") == "online") & (F.col("amount_usd") < max_amount))
                   .select("transaction_id", "card_id", "event_ts", "amount_usd"))
    bursts = skew.trailing_counts(small, "card_id", "epoch", {"burst_count": window_s}, slice_seconds).filter(F.col("burst_count") >= min_count)
    return skew.with_counts(small, bursts, "card_id", "epoch").select(
        "transaction_id", "card_id", "event_ts", "amount_usd", "burst_count")


def account_takeover(feats: DataFrame, min_km: float = TAKEOVER_MIN_KM, min_z: float = TAKEOVER_MIN_Z) -> DataFrame:
    return feats.filter((F.col("is_new_device") == 1) & (F.col("geo_distance_from_home_km") > min_km)
                        & (F.col("amount_zscore") > min_z)).select(
        "transaction_id", "card_id", "geo_distance_from_home_km", "amount_zscore")


def geo_impossible(feats: DataFrame, max_speed_kmh: float = JET_SPEED_KMH) -> DataFrame:
    return feats.filter(F.col("implied_speed_kmh") > max_speed_kmh).select(
        "transaction_id", "card_id", "geo_distance_from_prev_km", "seconds_since_prev", "implied_speed_kmh")


def amount_anomaly(feats: DataFrame, min_z: float = ANOMALY_MIN_Z) -> DataFrame:
    return feats.filter(F.col("amount_zscore") > min_z).select(
        "transaction_id", "card_id", "amount_usd", "amount_zscore")


def merchant_collusion(feats: DataFrame, dim_merch: DataFrame, window_s: int = COLLUSION_WINDOW_S,
                       min_count: int = COLLUSION_MIN_COUNT, slice_seconds: int = skew.SLICE_SECONDS) -> DataFrame:
    """Transactions at high-risk-tier merchants with at least ``min_count``
    transactions at the same merchant in the trailing ``window_s`` seconds.
    A busy merchant is the classic hot key: its window has one row a second."""
    high = dim_merch.filter(F.col("risk_tier") == HIGH_RISK_TIER).select("merchant_id")
    rows = _epoch(feats.select("transaction_id", "merchant_id", "card_id", "event_ts")
                  .join(high, "merchant_id", "left_semi"))
    bursts = skew.trailing_counts(rows, "merchant_id", "epoch", {"cluster_count": window_s}, slice_seconds).filter(F.col("cluster_count") >= min_count)
    return skew.with_counts(rows, bursts, "merchant_id", "epoch").select(
        "transaction_id", "merchant_id", "card_id", "event_ts", "cluster_count")


def diurnal_profile(feats: DataFrame) -> DataFrame:
    """Share of transactions per hour of day (24 rows)."""
    per = feats.groupBy(F.hour("event_ts").alias("event_hour")).agg(F.count(F.lit(1)).alias("txns"))
    total = per.select(F.sum("txns")).scalar()
    return per.select("event_hour", "txns", (F.col("txns") / total).alias("share"))
