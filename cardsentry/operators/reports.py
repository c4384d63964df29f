"""Dashboard tiles and headline KPIs over the gold marts.

Tiles read the pre-aggregated hourly/merchant marts (two-level aggregation);
KPIs read the fact.  Every result is small (per day, per hour, per merchant
or one row); only the fact scans are large, and they aggregate map-side.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.expr import count_if, money_sum, pct, ratio, rounded_mean

# Tile and report sizes.
TOP_RISKY_MERCHANTS = 20
RISKY_MIN_TXNS_EXCLUSIVE = 20
ALERT_QUEUE = 100
KPI_TOP_MERCHANTS = 12
KPI_MIN_TXNS = 20
HOURS = 24


# ---------------------------------------------------------------- tiles
def tile_daily_fraud(agg_hour: DataFrame) -> DataFrame:
    return (agg_hour.groupBy("event_date").agg(
        F.sum("txn_count").alias("transactions"),
        F.round(money_sum(F.col("fraud_usd")), 0).alias("fraud_dollars"),
        F.round(pct(F.sum("fraud_count"), F.sum("txn_count")), 3).alias("fraud_rate_pct"),
    ).orderBy("event_date"))


def tile_hour_heatmap(agg_hour: DataFrame) -> DataFrame:
    """Unweighted mean of the daily hourly rates (as the tile defines it)."""
    return (agg_hour.groupBy("event_hour").agg(
        rounded_mean(F.col("fraud_rate_pct"), 4, 3).alias("avg_fraud_rate_pct"),
        F.sum("fraud_count").alias("fraud_count"),
    ).orderBy("event_hour"))


def tile_top_risky_merchants(merchant_risk: DataFrame, n: int = TOP_RISKY_MERCHANTS,
                             min_txns_exclusive: int = RISKY_MIN_TXNS_EXCLUSIVE) -> DataFrame:
    return (merchant_risk.filter(F.col("txn_count") > min_txns_exclusive)
            .orderBy(F.col("observed_fraud_rate").desc(), F.col("merchant_id").asc())
            .limit(n)
            .select("merchant_id", "merchant_name", "merchant_category", "risk_tier", "txn_count",
                    "observed_fraud_rate", F.round("chargeback_usd", 0).alias("chargeback_usd")))


def tile_exposure_trend(exposure: DataFrame) -> DataFrame:
    return exposure.select("event_date", "confirmed_loss_usd", "outstanding_exposure_usd").orderBy("event_date")


def tile_precision_recall(perf: DataFrame) -> DataFrame:
    return perf.select("event_date", "precision", "recall", "scored_txns").orderBy("event_date")


def tile_alert_queue(alerts: DataFrame, dim_merch: DataFrame, n: int = ALERT_QUEUE) -> DataFrame:
    """Latest alerts with merchant names.  The top-n is taken *before* the
    merchant join, so the join touches n rows whatever the alert volume."""
    top = (alerts.filter(F.col("is_alert"))
           .orderBy(F.col("event_ts").desc(), F.col("transaction_id").desc())
           .limit(n))
    m = dim_merch.select("merchant_id", "merchant_name")
    return top.join(m, "merchant_id", "left").select(
        "transaction_id", "card_id", "merchant_name", "amount",
        F.round("fraud_score", 3).alias("score"), "event_ts")


# ---------------------------------------------------------------- KPIs
def kpi_headline(fact: DataFrame, chargebacks: DataFrame) -> DataFrame:
    fraud = F.col("is_fraud_label")
    n_cb = chargebacks.select(F.count(F.lit(1))).scalar()
    return fact.agg(
        F.count(F.lit(1)).alias("transactions"),
        count_if(fraud).alias("fraud_count"),
        F.round(ratio(count_if(fraud), F.count(F.lit(1))) * 100, 3).alias("fraud_rate_pct"),
        F.bround(money_sum(F.col("amount_usd")), 0).alias("gmv_usd"),
        F.bround(money_sum(F.col("amount_usd"), fraud), 0).alias("fraud_usd"),
        F.count_distinct(F.when(fraud, F.col("card_id"))).alias("compromised_cards"),
        F.count_distinct("event_date").alias("window_days"),
    ).withColumn("chargebacks", n_cb)


def kpi_by_pattern(fact: DataFrame) -> DataFrame:
    return (fact.filter(F.col("is_fraud_label")).groupBy("fraud_type_label").agg(
        F.count(F.lit(1)).alias("count"),
        F.round(money_sum(F.col("amount_usd")), 0).alias("usd"),
    ).withColumnRenamed("fraud_type_label", "fraud_type")
      .orderBy(F.col("count").desc(), F.col("fraud_type")))


def kpi_hourly(fact: DataFrame) -> DataFrame:
    """Hour-of-day profile with every hour present (0 where no rows).  The
    spine has 24 rows, so broadcasting the 24-row aggregate is bounded."""
    spark = fact.sparkSession
    per = fact.groupBy("event_hour").agg(
        F.count(F.lit(1)).alias("txns"), count_if(F.col("is_fraud_label")).alias("fraud"))
    spine = spark.range(HOURS).select(F.col("id").cast("int").alias("event_hour"))
    j = spine.join(F.broadcast(per), "event_hour", "left")
    return j.select(
        "event_hour",
        F.coalesce("txns", F.lit(0).cast("bigint")).alias("txns"),
        F.coalesce("fraud", F.lit(0).cast("bigint")).alias("fraud"),
        F.coalesce(F.round(pct(F.col("fraud"), F.col("txns")), 3), F.lit(0.0)).alias("fraud_rate_pct"),
    ).orderBy("event_hour")


def kpi_exposure(fact: DataFrame) -> DataFrame:
    fraud, cb, amt = F.col("is_fraud_label"), F.col("is_confirmed_fraud"), F.col("amount_usd")
    return fact.agg(
        F.bround(money_sum(amt, cb), 0).alias("confirmed_loss_usd"),
        F.bround(money_sum(amt, fraud & ~cb), 0).alias("outstanding_usd"),
        F.bround(money_sum(amt, ~fraud & cb), 0).alias("disputed_non_fraud_usd"),
    )


def kpi_feature_separation(fact: DataFrame) -> DataFrame:
    """Mean feature values for legitimate vs fraudulent rows."""
    return fact.groupBy("is_fraud_label").agg(
        F.round(ratio(money_sum(F.col("amount_usd")), F.count("amount_usd")), 2).alias("amount"),
        F.round(F.avg("geo_distance_from_home_km"), 2).alias("geo_from_home_km"),
        F.round(F.avg("geo_distance_from_prev_km"), 2).alias("geo_from_prev_km"),
        F.round(F.avg("implied_speed_kmh"), 2).alias("implied_speed_kmh"),
        rounded_mean(F.col("is_new_device") * 100, 0, 2).alias("is_new_device_pct"),
    )


def kpi_top_merchants(fact: DataFrame, merchants: DataFrame, n: int = KPI_TOP_MERCHANTS,
                      min_txns: int = KPI_MIN_TXNS) -> DataFrame:
    per = fact.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("txns"),
        count_if(F.col("is_fraud_label")).alias("fraud"),
        money_sum(F.col("amount_usd")).alias("gmv"),
    ).filter(F.col("txns") >= min_txns)
    top = (per.withColumn("observed_fraud_rate", F.round(ratio(F.col("fraud"), F.col("txns")), 4))
           .orderBy(F.col("observed_fraud_rate").desc(), F.col("merchant_id").asc()).limit(n))
    m = merchants.select("merchant_id", F.col("merchant_name").alias("name"),
                         F.col("merchant_category").alias("category"), "baseline_fraud_rate")
    return top.join(m, "merchant_id", "left").select(
        "merchant_id", "name", "category", "txns", "fraud", "observed_fraud_rate", "baseline_fraud_rate")
