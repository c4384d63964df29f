"""Staging, joins, windows, features, fact and marts."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geo import haversine_km
from ..operators import features as feat, gold, staging
from .catalog import register
from .context import FEATURE_ROUND, Pipeline, ntz, report_rounded
from .oracle import behaviour, hav, q, sround


def _p(spark, sf_dir):
    return Pipeline.get(spark, sf_dir)


def _sql_feats(cols, prefix=""):
    return ", ".join(sround(prefix + c, FEATURE_ROUND[c]) + f" AS {c}" if c in FEATURE_ROUND else prefix + c
                     for c in cols)


# ---------------------------------------------------------------- staging (PRJ)
for _i, (_name, _tab) in enumerate([("stg_transactions", "transactions"), ("stg_auth_events", "auth_events"),
                                    ("stg_chargebacks", "chargebacks"), ("stg_accounts", "accounts"),
                                    ("stg_cards", "cards"), ("stg_merchants", "merchants")], start=1):
    register(f"prj_{_i:02d}_{_name}", q(f"SELECT * FROM {_name}"))(
        lambda spark, sf_dir, _tab=_tab: ntz(_p(spark, sf_dir).silver[_tab]))


@register("prj_07_silver_dedup", q("""
, bronze AS (
  SELECT transaction_id, amount, ts AS _ingest_ts FROM raw_transactions
  UNION ALL
  SELECT transaction_id, amount + 1, ts + INTERVAL 1 HOUR FROM raw_transactions WHERE transaction_id % 10 = 0)
SELECT transaction_id, amount, _ingest_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY _ingest_ts DESC) AS rn FROM bronze)
WHERE rn = 1""".replace("\n, bronze", ", bronze", 1)))
def prj_07(spark, sf_dir):
    t = _p(spark, sf_dir).raw["transactions"]
    bronze = t.select("transaction_id", "amount", F.col("ts").alias("_ingest_ts")).unionByName(
        t.filter(F.col("transaction_id") % 10 == 0).select(
            "transaction_id", (F.col("amount") + 1).alias("amount"),
            (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("_ingest_ts")))
    return ntz(staging.dedup_latest(bronze, "transaction_id", "_ingest_ts"))


@register("prj_08_dim_merchant", q("SELECT * FROM dim_merchant"))
def prj_08(spark, sf_dir):
    return _p(spark, sf_dir).dim_merchant


@register("prj_10_alert_filter", q(
    "SELECT transaction_id, fraud_score FROM live_fraud_alerts WHERE is_alert AND event_ts IS NOT NULL"))
def prj_10(spark, sf_dir):
    a = _p(spark, sf_dir).alerts
    return a.filter(F.col("is_alert") & F.col("event_ts").isNotNull()).select("transaction_id", "fraud_score")


@register("prj_11_distinct_fraud_cards", q(
    "SELECT DISTINCT card_id FROM stg_transactions WHERE is_fraud_label"))
def prj_11(spark, sf_dir):
    t = _p(spark, sf_dir).silver["transactions"]
    return t.filter("is_fraud_label").select("card_id").distinct()


@register("prj_12_model_input_fillna", q(
    "SELECT transaction_id, " + ", ".join(
        f"coalesce({sround(c, FEATURE_ROUND[c]) if c in FEATURE_ROUND else c}, 0) AS {c}" for c in feat.FEATURES)
    + " FROM features"))
def prj_12(spark, sf_dir):
    f = _p(spark, sf_dir).features.select("transaction_id", *feat.FEATURES)
    return report_rounded(f).fillna(0, subset=feat.FEATURES)


# ---------------------------------------------------------------- joins (JOIN)
@register("join_01_txn_cards", q("""
SELECT t.transaction_id, t.card_id, c.account_id, c.home_lat, c.home_lon, c.primary_device_id
FROM stg_transactions t LEFT JOIN stg_cards c ON t.card_id = c.card_id"""))
def join_01(spark, sf_dir):
    s = _p(spark, sf_dir).silver
    c = s["cards"].select("card_id", "account_id", "home_lat", "home_lon", "primary_device_id")
    return s["transactions"].select("transaction_id", "card_id").join(c, "card_id", "left")


@register("join_02_txn_merchants", q("""
SELECT t.transaction_id, t.merchant_id, m.merchant_category, m.baseline_fraud_rate
FROM stg_transactions t LEFT JOIN stg_merchants m ON t.merchant_id = m.merchant_id"""))
def join_02(spark, sf_dir):
    s = _p(spark, sf_dir).silver
    m = s["merchants"].select("merchant_id", "merchant_category", "baseline_fraud_rate")
    return s["transactions"].select("transaction_id", "merchant_id").join(m, "merchant_id", "left")


@register("join_04_fact_auth", q("""
SELECT transaction_id, is_approved, decline_reason FROM fct_transactions"""))
def join_04(spark, sf_dir):
    return _p(spark, sf_dir).fact.select("transaction_id", "is_approved", "decline_reason")


@register("join_05_first_chargeback", q("SELECT transaction_id, chargeback_reason FROM first_cb"))
def join_05(spark, sf_dir):
    return gold.first_chargeback(_p(spark, sf_dir).silver["chargebacks"]).select(
        "transaction_id", "chargeback_reason")


@register("join_12_chargeback_flag", q("""
SELECT t.transaction_id, c.transaction_id IS NOT NULL AS is_confirmed_fraud
FROM stg_transactions t LEFT JOIN (SELECT DISTINCT transaction_id FROM stg_chargebacks) c
  ON t.transaction_id = c.transaction_id"""))
def join_12(spark, sf_dir):
    s = _p(spark, sf_dir).silver
    ids = s["chargebacks"].select("transaction_id").distinct().withColumn("_m", F.lit(True))
    return (s["transactions"].select("transaction_id").join(ids, "transaction_id", "left")
            .select("transaction_id", F.col("_m").isNotNull().alias("is_confirmed_fraud")))


# ---------------------------------------------------------------- windows (WIN)
def _win(spark, sf_dir, cols, rnd=None):
    w = feat.card_windows(_p(spark, sf_dir).silver["transactions"])
    out = w.select("transaction_id", "card_id", *cols)
    if rnd:
        out = out.select("transaction_id", "card_id", *[F.round(c, rnd).alias(c) for c in cols])
    return ntz(out)


_WSQL = "SELECT transaction_id, card_id, {cols} FROM windowed"
for _key, _cols, _rnd in [("win_01_lag_event_ts", ["prev_ts"], None),
                          ("win_02_lag_lat", ["prev_lat"], None),
                          ("win_03_lag_lon", ["prev_lon"], None),
                          ("win_04_rolling_mean_amount", ["card_amount_mean"], 9),
                          ("win_05_rolling_std_amount", ["card_amount_std"], 9),
                          ("win_06_velocity_60s", ["txn_count_60s"], None),
                          ("win_07_velocity_1h", ["txn_count_1h"], None)]:
    _sel = ", ".join(sround(c, _rnd) + f" AS {c}" if _rnd else c for c in _cols)
    register(_key, q(_WSQL.format(cols=_sel)))(
        lambda spark, sf_dir, _cols=_cols, _rnd=_rnd: _win(spark, sf_dir, _cols, _rnd))


@register("win_08_group_shift", q("""
SELECT transaction_id, card_id, prev_ts, prev_lat, prev_lon FROM windowed"""))
def win_08(spark, sf_dir):
    return _win(spark, sf_dir, ["prev_ts", "prev_lat", "prev_lon"])


@register("win_09_last_per_card", q("""
SELECT card_id, arg_max(transaction_id, (event_ts, transaction_id)) AS transaction_id,
       arg_max(event_ts, (event_ts, transaction_id)) AS event_ts,
       arg_max(lat, (event_ts, transaction_id)) AS lat, arg_max(lon, (event_ts, transaction_id)) AS lon
FROM stg_transactions GROUP BY card_id"""))
def win_09(spark, sf_dir):
    t = _p(spark, sf_dir).silver["transactions"]
    return ntz(feat.last_per_key(t, "card_id", ["event_ts", "transaction_id"],
                                 ["transaction_id", "event_ts", "lat", "lon"]))


# ---------------------------------------------------------------- features (FEAT)
@register("feat_00_haversine_txn_merchant", q(f"""
SELECT t.transaction_id, {sround(hav('t.lat', 't.lon', 'm.lat', 'm.lon'), 3)} AS km_to_merchant
FROM stg_transactions t LEFT JOIN stg_merchants m ON t.merchant_id = m.merchant_id"""))
def feat_00(spark, sf_dir):
    s = _p(spark, sf_dir).silver
    m = s["merchants"].select("merchant_id", F.col("lat").alias("m_lat"), F.col("lon").alias("m_lon"))
    t = s["transactions"].select("transaction_id", "merchant_id", "lat", "lon").join(m, "merchant_id", "left")
    return t.select("transaction_id", F.round(haversine_km("lat", "lon", "m_lat", "m_lon"), 3).alias("km_to_merchant"))


for _i, _f in enumerate(feat.FEATURES, start=1):
    register(f"feat_{_i:02d}_{_f}", q(f"SELECT transaction_id, {_sql_feats([_f])} FROM features"))(
        lambda spark, sf_dir, _f=_f: report_rounded(_p(spark, sf_dir).features.select("transaction_id", _f)))


@register("feat_11_feature_rows", q(f"SELECT {_sql_feats(feat.OUTPUT_COLS)} FROM features"))
def feat_11(spark, sf_dir):
    return report_rounded(_p(spark, sf_dir).features)


@register("feat_12_feature_rows_hot_slices", q(f"SELECT {_sql_feats(feat.OUTPUT_COLS)} FROM features"))
def feat_12(spark, sf_dir):
    """Same rows through the hot-card path: every card with more than 20 rows
    is evaluated in time slices with halo context (exactness check of the
    skew strategy on whole tables)."""
    return report_rounded(Pipeline.get(spark, sf_dir, hot_card_rows=20).features)


_SKEW_COLS = ["transaction_id", "card_id", "amount_log", "seconds_since_prev", "geo_distance_from_prev_km",
              "amount_zscore", "txn_count_60s", "txn_count_1h", "implied_speed_kmh"]
_SKEW_SQL = q(f"""
, skewed AS (SELECT * REPLACE (CASE WHEN transaction_id % 3 = 0 THEN CAST(0 AS BIGINT) ELSE card_id END AS card_id)
             FROM stg_transactions)
, {behaviour('skewed', 'skewed_')}
SELECT {_sql_feats(_SKEW_COLS)} FROM skewed_features""")


def _skewed(spark, sf_dir, hot):
    p = _p(spark, sf_dir)
    t = p.silver["transactions"].withColumn(
        "card_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("card_id")))
    return report_rounded(p.compute_features(t, hot_card_rows=hot).select(*_SKEW_COLS))


@register("feat_13_one_card_holds_a_third", _SKEW_SQL)
def feat_13(spark, sf_dir):
    """Worst-case skew on whole tables: every third transaction is moved onto
    card 0, so one card holds a third of all rows.  Cards above 2,000 rows are
    evaluated in time slices; the result equals the unsliced window."""
    return _skewed(spark, sf_dir, 2000)


# ---------------------------------------------------------------- fact and marts (AGG)
@register("agg_01_fct_transactions", q(f"SELECT {_sql_feats([c for c in gold.FACT_COLS])} FROM fct_transactions"))
def agg_01(spark, sf_dir):
    return report_rounded(_p(spark, sf_dir).fact)


@register("agg_02_fraud_by_hour", q("SELECT * FROM agg_fraud_by_hour"))
def agg_02(spark, sf_dir):
    return _p(spark, sf_dir).agg_fraud_by_hour


@register("agg_03_merchant_risk", q("SELECT * FROM agg_merchant_risk"))
def agg_03(spark, sf_dir):
    return _p(spark, sf_dir).agg_merchant_risk


@register("agg_04_chargeback_exposure", q("SELECT * FROM mart_chargeback_exposure ORDER BY event_date"))
def agg_04(spark, sf_dir):
    return _p(spark, sf_dir).exposure


@register("agg_05_model_performance", q("SELECT * FROM mart_model_performance ORDER BY event_date"))
def agg_05(spark, sf_dir):
    return _p(spark, sf_dir).model_performance

