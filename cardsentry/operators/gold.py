"""Gold layer: transaction fact, conformed dimensions and marts."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.expr import count_if, money_sum, pct, ratio
from .features import FEATURES

# Merchant risk tiers by category.
HIGH_RISK_CATEGORIES = ["crypto_exchange", "gambling", "money_transfer"]
MEDIUM_RISK_CATEGORIES = ["electronics", "travel"]

FACT_COLS = [
    "transaction_id", "card_id", "merchant_id", "account_id", "merchant_category",
    "event_ts", "event_date", "event_hour", "entry_mode", "amount_usd", *FEATURES,
    "is_approved", "decline_reason", "is_confirmed_fraud", "chargeback_reason",
    "is_fraud_label", "fraud_type_label",
]


def first_chargeback(chargebacks: DataFrame) -> DataFrame:
    """One row per disputed transaction: the earliest (settle_ts, chargeback_id).

    An aggregate, not a window: partial aggregation collapses repeats before
    the shuffle, and the output is already partitioned by transaction_id for
    the fact join.
    """
    first = F.struct("settle_ts", "chargeback_id")
    return (chargebacks.groupBy("transaction_id")
            .agg(F.min_by("reason_code", first).alias("chargeback_reason"))
            .withColumn("has_chargeback", F.lit(True)))


def fct_transactions(features: DataFrame, auth: DataFrame, chargebacks: DataFrame) -> DataFrame:
    a = auth.select("transaction_id", "is_approved", "decline_reason")
    cb = first_chargeback(chargebacks)
    j = features.join(a, "transaction_id", "left").join(cb, "transaction_id", "left")
    return j.select(
        *[c for c in FACT_COLS if c not in ("event_hour", "is_approved", "is_confirmed_fraud")],
        F.hour("event_ts").alias("event_hour"),
        F.coalesce(F.col("is_approved"), F.lit(True)).alias("is_approved"),
        F.coalesce(F.col("has_chargeback"), F.lit(False)).alias("is_confirmed_fraud"),
    ).select(*FACT_COLS)


def dim_merchant(merchants: DataFrame) -> DataFrame:
    cat = F.col("merchant_category")
    return merchants.select(
        "merchant_id", "merchant_name", "merchant_category", "merchant_country",
        "baseline_fraud_rate",
        F.when(cat.isin(HIGH_RISK_CATEGORIES), F.lit("high"))
         .when(cat.isin(MEDIUM_RISK_CATEGORIES), F.lit("medium"))
         .otherwise(F.lit("low")).alias("risk_tier"),
    )


def dim_card(card_history: DataFrame, accounts: DataFrame) -> DataFrame:
    """Current card versions (open SCD2 rows) with account attributes."""
    cur = card_history.filter(F.col("valid_to").isNull())
    acc = accounts.select("account_id", F.col("risk_band").alias("account_risk_band"),
                          F.col("signup_date").alias("account_signup_date"))
    return cur.join(acc, "account_id", "left").select(
        "card_id", "account_id", "card_type", "home_country", "is_active",
        "account_risk_band", "account_signup_date")


def agg_fraud_by_hour(fact: DataFrame) -> DataFrame:
    fraud, cb = F.col("is_fraud_label"), F.col("is_confirmed_fraud")
    return (fact.groupBy("event_date", "event_hour").agg(
        F.count(F.lit(1)).alias("txn_count"),
        money_sum(F.col("amount_usd")).alias("gmv_usd"),
        count_if(fraud).alias("fraud_count"),
        money_sum(F.col("amount_usd"), fraud).alias("fraud_usd"),
        money_sum(F.col("amount_usd"), cb).alias("chargeback_usd"),
        count_if(~F.col("is_approved")).alias("declined_count"),
    ).withColumn("fraud_rate_pct", F.round(pct(F.col("fraud_count"), F.col("txn_count")), 4)))


def agg_merchant_risk(fact: DataFrame, dim_merch: DataFrame) -> DataFrame:
    """Per-merchant scorecard.  The fact is aggregated per merchant_id *before*
    the join, so only one row per merchant crosses the join shuffle."""
    fraud, cb = F.col("is_fraud_label"), F.col("is_confirmed_fraud")
    per = fact.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("txn_count"),
        money_sum(F.col("amount_usd")).alias("gmv_usd"),
        count_if(fraud).alias("fraud_count"),
        money_sum(F.col("amount_usd"), cb).alias("chargeback_usd"),
    )
    d = dim_merch.select("merchant_id", "merchant_name", "merchant_category", "risk_tier",
                         "baseline_fraud_rate")
    return per.join(d, "merchant_id", "inner").select(
        "merchant_id", "merchant_name", "merchant_category", "risk_tier", "baseline_fraud_rate",
        "txn_count", "gmv_usd", "fraud_count",
        F.round(ratio(F.col("fraud_count"), F.col("txn_count")), 4).alias("observed_fraud_rate"),
        "chargeback_usd",
    )


def mart_chargeback_exposure(fact: DataFrame) -> DataFrame:
    fraud, cb, amt = F.col("is_fraud_label"), F.col("is_confirmed_fraud"), F.col("amount_usd")
    return (fact.groupBy("event_date").agg(
        money_sum(amt, cb).alias("confirmed_loss_usd"),
        money_sum(amt, fraud & ~cb).alias("outstanding_exposure_usd"),
        money_sum(amt, ~fraud & cb).alias("disputed_non_fraud_usd"),
        F.count(F.when(cb, F.lit(1))).alias("chargeback_count"),
    ).orderBy("event_date"))


def mart_model_performance(fact: DataFrame, scores: DataFrame) -> DataFrame:
    lab = fact.select("transaction_id", "event_date", "is_fraud_label")
    s = scores.select("transaction_id", "is_alert")
    j = lab.join(s, "transaction_id", "inner")
    alert, fraud = F.col("is_alert"), F.col("is_fraud_label")
    return (j.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("scored_txns"),
        count_if(alert & fraud).alias("true_positives"),
        count_if(alert & ~fraud).alias("false_positives"),
        count_if(~alert & fraud).alias("false_negatives"),
        count_if(alert).alias("_alerts"),
        count_if(fraud).alias("_frauds"),
    ).select(
        "event_date", "scored_txns", "true_positives", "false_positives", "false_negatives",
        F.round(ratio(F.col("true_positives"), F.col("_alerts")), 4).alias("precision"),
        F.round(ratio(F.col("true_positives"), F.col("_frauds")), 4).alias("recall"),
    ).orderBy("event_date"))
