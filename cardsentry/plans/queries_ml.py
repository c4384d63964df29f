"""Evaluation metrics on the rule score, training-set preparation, detectors."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import detect, metrics
from .catalog import register
from .context import Pipeline, ntz
from .oracle import q, sround

SPLIT_DATE = "2024-01-24"
MATURITY_AS_OF = "2024-03-01"


def _p(spark, sf_dir):
    return Pipeline.get(spark, sf_dir)


def scored(p: Pipeline):
    a = p.alerts.select("transaction_id", F.col("fraud_score").alias("score"))
    return p.fact.select("transaction_id", "event_date", F.col("is_fraud_label").cast("int").alias("label")) \
                 .join(a, "transaction_id")


SCORED_SQL = """
, scored AS (SELECT f.transaction_id, f.event_date, a.fraud_score AS score, CAST(f.is_fraud_label AS INTEGER) AS label
             FROM fct_transactions f JOIN live_fraud_alerts a ON f.transaction_id = a.transaction_id)
, per AS (SELECT score, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
                 CAST(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM scored GROUP BY score)
, tot AS (SELECT CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM per)
, cum AS (SELECT score AS threshold, pos, neg,
                 CAST(sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
                 CAST(sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp,
                 n_pos, n_neg FROM per, tot)
, pr AS (SELECT *, CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / nullif(n_pos, 0) AS recall FROM cum)
, curve AS (SELECT threshold, pos, neg, tp, fp, precision, recall,
                   CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) ELSE CAST(0 AS DOUBLE) END AS f1,
                   n_pos, n_neg FROM pr)
"""


@register("ml_01_time_split", q(f"""
SELECT transaction_id, event_date, CASE WHEN event_date < DATE '{SPLIT_DATE}' THEN 'train' ELSE 'test' END AS split
FROM fct_transactions"""))
def ml_01(spark, sf_dir):
    f = _p(spark, sf_dir).fact.select("transaction_id", "event_date")
    return metrics.time_split(f, SPLIT_DATE)


@register("ml_02_quantile_split", q("""
, d AS (SELECT *, datediff('day', DATE '1970-01-01', event_date) AS day FROM fct_transactions)
, cut AS (SELECT quantile_cont(day, 0.8) AS q FROM d)
SELECT CASE WHEN day <= q THEN 'train' ELSE 'test' END AS split, count(*) AS n,
       CAST(sum(CASE WHEN is_confirmed_fraud THEN 1 ELSE 0 END) AS BIGINT) AS positives,
       min(event_date) AS first_date, max(event_date) AS last_date
FROM d, cut GROUP BY 1"""))
def ml_02(spark, sf_dir):
    f = metrics.quantile_split(_p(spark, sf_dir).fact)
    return f.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("is_confirmed_fraud").cast("int")).cast("bigint").alias("positives"),
        F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date"))


@register("ml_03_mature_labels", q(f"""
SELECT transaction_id, event_date, CAST(is_confirmed_fraud AS INTEGER) AS label FROM fct_transactions
WHERE event_date <= DATE '{MATURITY_AS_OF}' - INTERVAL 45 DAY"""))
def ml_03(spark, sf_dir):
    return metrics.mature_labels(_p(spark, sf_dir).fact, MATURITY_AS_OF).select("transaction_id", "event_date", "label")


@register("ml_04_class_weight", q("""
, l AS (SELECT CAST(is_fraud_label AS INTEGER) AS label FROM fct_transactions)
, s AS (SELECT count(*) AS n, sum(label) AS pos FROM l)
SELECT label, CASE WHEN label = 1 THEN CAST(n - pos AS DOUBLE) / greatest(pos, 1) ELSE CAST(1.0 AS DOUBLE) END AS weight,
       count(*) AS rows
FROM l, s GROUP BY label, weight"""))
def ml_04(spark, sf_dir):
    f = _p(spark, sf_dir).fact.select(F.col("is_fraud_label").cast("int").alias("label"))
    w = metrics.with_class_weight(f)
    return w.groupBy("label", "weight").agg(F.count(F.lit(1)).alias("rows"))


@register("ml_07_pr_curve", q(SCORED_SQL + "SELECT * FROM curve"))
def ml_07(spark, sf_dir):
    return metrics.pr_curve(scored(_p(spark, sf_dir)))


@register("ml_07b_pr_curve_bucketed", q(SCORED_SQL + "SELECT * FROM curve"))
def ml_07b(spark, sf_dir):
    """Same curve with its scores in 37 ranges."""
    return metrics.pr_curve(scored(_p(spark, sf_dir)), ranges=37)


@register("ml_08_average_precision", q(SCORED_SQL + f"""
SELECT {sround('sum(CAST(pos AS DOUBLE) / n_pos * precision)', 9)} AS average_precision FROM curve"""))
def ml_08(spark, sf_dir):
    ap = metrics.average_precision(metrics.pr_curve(scored(_p(spark, sf_dir))))
    return ap.select(F.round("average_precision", 9).alias("average_precision"))


@register("ml_09_roc_auc", q(SCORED_SQL + f"""
SELECT {sround('sum(CAST(neg AS DOUBLE) / n_neg * ((tp - pos) + pos / 2.0) / n_pos)', 9)} AS roc_auc FROM curve"""))
def ml_09(spark, sf_dir):
    auc = metrics.roc_auc(metrics.pr_curve(scored(_p(spark, sf_dir))))
    return auc.select(F.round("roc_auc", 9).alias("roc_auc"))


@register("ml_10_best_threshold", q(SCORED_SQL + """
SELECT threshold, f1 FROM curve ORDER BY f1 DESC, threshold DESC LIMIT 1"""))
def ml_10(spark, sf_dir):
    return metrics.best_threshold(metrics.pr_curve(scored(_p(spark, sf_dir))))


@register("ml_11_classification_report", q(SCORED_SQL + """
, c AS (SELECT CAST(sum(CASE WHEN score >= 0.5 AND label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
               CAST(sum(CASE WHEN score >= 0.5 AND label = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
               CAST(sum(CASE WHEN score < 0.5 AND label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
               CAST(sum(CASE WHEN score < 0.5 AND label = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn FROM scored)
, m AS (SELECT tp, fp, fn, tn,
               coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
               coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
               tp + fn AS s1, tn + fp AS s0 FROM c)
, f AS (SELECT *, CASE WHEN p1 + r1 > 0 THEN 2.0 * p1 * r1 / (p1 + r1) ELSE 0 END AS f1,
               CASE WHEN p0 + r0 > 0 THEN 2.0 * p0 * r0 / (p0 + r0) ELSE 0 END AS f0, s0 + s1 AS n FROM m)
SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, CAST(s0 AS BIGINT) AS support FROM f
UNION ALL SELECT '1', p1, r1, f1, CAST(s1 AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, (tp + tn) / n, CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, CAST(n AS BIGINT) FROM f"""))
def ml_11(spark, sf_dir):
    return metrics.classification_report(scored(_p(spark, sf_dir)), 0.5)


# ---------------------------------------------------------------- detectors
_E = "epoch_us(event_ts) // 1000000"


@register("det_01_card_testing", q(f"""
SELECT transaction_id, card_id, event_ts, amount_usd, burst_count FROM (
  SELECT *, count(*) OVER (PARTITION BY card_id ORDER BY {_E} RANGE BETWEEN {detect.TESTING_WINDOW_S} PRECEDING AND CURRENT ROW) AS burst_count
  FROM fct_transactions WHERE entry_mode = 'online' AND amount_usd < {detect.TESTING_MAX_AMOUNT})
WHERE burst_count >= {detect.TESTING_MIN_COUNT}"""))
def det_01(spark, sf_dir):
    return ntz(detect.card_testing(_p(spark, sf_dir).features))


@register("det_01b_card_testing_hot_slices", q(f"""
SELECT transaction_id, card_id, event_ts, amount_usd, burst_count FROM (
  SELECT *, count(*) OVER (PARTITION BY card_id ORDER BY {_E} RANGE BETWEEN {detect.TESTING_WINDOW_S} PRECEDING AND CURRENT ROW) AS burst_count
  FROM fct_transactions WHERE entry_mode = 'online' AND amount_usd < {detect.TESTING_MAX_AMOUNT})
WHERE burst_count >= {detect.TESTING_MIN_COUNT}"""))
def det_01b(spark, sf_dir):
    return ntz(detect.card_testing(_p(spark, sf_dir).features, slice_seconds=60))


@register("det_02_account_takeover", q(f"""
SELECT transaction_id, card_id, {sround('geo_distance_from_home_km', 3)} AS geo_distance_from_home_km,
       {sround('amount_zscore', 6)} AS amount_zscore FROM fct_transactions
WHERE is_new_device = 1 AND geo_distance_from_home_km > {detect.TAKEOVER_MIN_KM} AND amount_zscore > {detect.TAKEOVER_MIN_Z}"""))
def det_02(spark, sf_dir):
    d = detect.account_takeover(_p(spark, sf_dir).features)
    return d.select("transaction_id", "card_id", F.round("geo_distance_from_home_km", 3).alias("geo_distance_from_home_km"),
                    F.round("amount_zscore", 6).alias("amount_zscore"))


@register("det_03_geo_impossible", q(f"""
SELECT transaction_id, card_id, {sround('geo_distance_from_prev_km', 3)} AS geo_distance_from_prev_km,
       seconds_since_prev, {sround('implied_speed_kmh', 2)} AS implied_speed_kmh FROM fct_transactions
WHERE implied_speed_kmh > {detect.JET_SPEED_KMH}"""))
def det_03(spark, sf_dir):
    d = detect.geo_impossible(_p(spark, sf_dir).features)
    return d.select("transaction_id", "card_id", F.round("geo_distance_from_prev_km", 3).alias("geo_distance_from_prev_km"),
                    "seconds_since_prev", F.round("implied_speed_kmh", 2).alias("implied_speed_kmh"))


@register("det_04_amount_anomaly", q(f"""
SELECT transaction_id, card_id, amount_usd, {sround('amount_zscore', 6)} AS amount_zscore FROM fct_transactions
WHERE amount_zscore > {detect.ANOMALY_MIN_Z}"""))
def det_04(spark, sf_dir):
    d = detect.amount_anomaly(_p(spark, sf_dir).features)
    return d.select("transaction_id", "card_id", "amount_usd", F.round("amount_zscore", 6).alias("amount_zscore"))


_COLLUSION_SQL = f"""
SELECT transaction_id, merchant_id, card_id, event_ts, cluster_count FROM (
  SELECT f.transaction_id, f.merchant_id, f.card_id, f.event_ts,
         count(*) OVER (PARTITION BY f.merchant_id ORDER BY epoch_us(f.event_ts) // 1000000
                        RANGE BETWEEN {detect.COLLUSION_WINDOW_S} PRECEDING AND CURRENT ROW) AS cluster_count
  FROM fct_transactions f JOIN dim_merchant m ON f.merchant_id = m.merchant_id WHERE m.risk_tier = 'high')
WHERE cluster_count >= {detect.COLLUSION_MIN_COUNT}"""


@register("det_05_merchant_collusion", q(_COLLUSION_SQL))
def det_05(spark, sf_dir):
    p = _p(spark, sf_dir)
    return ntz(detect.merchant_collusion(p.features, p.dim_merchant))


@register("det_05b_merchant_collusion_hot_slices", q(_COLLUSION_SQL))
def det_05b(spark, sf_dir):
    """Every high-risk merchant with more than 30 rows is sliced (exactness
    check of the hot-merchant path on whole tables)."""
    p = _p(spark, sf_dir)
    return ntz(detect.merchant_collusion(p.features, p.dim_merchant, slice_seconds=3600))


@register("det_06_diurnal_profile", q("""
, per AS (SELECT CAST(hour(event_ts) AS INTEGER) AS event_hour, count(*) AS txns FROM fct_transactions GROUP BY 1)
SELECT event_hour, txns, CAST(txns AS DOUBLE) / (SELECT sum(txns) FROM per) AS share FROM per"""))
def det_06(spark, sf_dir):
    return detect.diurnal_profile(_p(spark, sf_dir).features)
