"""Dashboard tiles, KPIs, ordering and set operations."""
from __future__ import annotations

from ..operators import reports
from .catalog import register
from .context import Pipeline, ntz
from .oracle import bround0, cnt, msum, q, sround, xmean


def _p(spark, sf_dir):
    return Pipeline.get(spark, sf_dir)


# ---------------------------------------------------------------- tiles
@register("agg_06_tile_daily_fraud", q(f"""
SELECT event_date, CAST(sum(txn_count) AS BIGINT) AS transactions,
       {sround(msum('fraud_usd'), 0)} AS fraud_dollars,
       {sround('CAST(100.0 AS DOUBLE) * sum(fraud_count) / sum(txn_count)', 3)} AS fraud_rate_pct
FROM agg_fraud_by_hour GROUP BY event_date ORDER BY event_date"""))
def agg_06(spark, sf_dir):
    return reports.tile_daily_fraud(_p(spark, sf_dir).agg_fraud_by_hour)


@register("agg_07_tile_hour_heatmap", q(f"""
SELECT event_hour, {xmean('fraud_rate_pct', 4, 3)} AS avg_fraud_rate_pct, CAST(sum(fraud_count) AS BIGINT) AS fraud_count
FROM agg_fraud_by_hour GROUP BY event_hour ORDER BY event_hour"""))
def agg_07(spark, sf_dir):
    return reports.tile_hour_heatmap(_p(spark, sf_dir).agg_fraud_by_hour)


@register("agg_08_tile_exposure_trend", q("""
SELECT event_date, confirmed_loss_usd, outstanding_exposure_usd FROM mart_chargeback_exposure ORDER BY event_date"""))
def agg_08(spark, sf_dir):
    return reports.tile_exposure_trend(_p(spark, sf_dir).exposure)


@register("agg_09_tile_precision_recall", q("""
SELECT event_date, precision, recall, scored_txns FROM mart_model_performance ORDER BY event_date"""))
def agg_09(spark, sf_dir):
    return reports.tile_precision_recall(_p(spark, sf_dir).model_performance)


@register("ord_01_top20_risky_merchants", q(f"""
SELECT merchant_id, merchant_name, merchant_category, risk_tier, txn_count, observed_fraud_rate,
       {sround('chargeback_usd', 0)} AS chargeback_usd
FROM agg_merchant_risk WHERE txn_count > 20
ORDER BY observed_fraud_rate DESC, merchant_id LIMIT 20"""))
def ord_01(spark, sf_dir):
    return reports.tile_top_risky_merchants(_p(spark, sf_dir).agg_merchant_risk)


@register("ord_03_live_alert_queue", q(f"""
SELECT a.transaction_id, a.card_id, m.merchant_name, a.amount, {sround('a.fraud_score', 3)} AS score, a.event_ts
FROM live_fraud_alerts a LEFT JOIN dim_merchant m ON a.merchant_id = m.merchant_id
WHERE a.is_alert ORDER BY a.event_ts DESC, a.transaction_id DESC LIMIT 100"""))
def ord_03(spark, sf_dir):
    p = _p(spark, sf_dir)
    return ntz(reports.tile_alert_queue(p.alerts, p.dim_merchant))


@register("ord_05_event_time_order", q("""
SELECT transaction_id, event_ts FROM stg_transactions ORDER BY event_ts, transaction_id"""))
def ord_05(spark, sf_dir):
    t = _p(spark, sf_dir).silver["transactions"]
    return ntz(t.select("transaction_id", "event_ts").orderBy("event_ts", "transaction_id"))


# ---------------------------------------------------------------- KPIs
@register("agg_10_kpi_headline", q(f"""
SELECT count(*) AS transactions, {cnt('is_fraud_label')} AS fraud_count,
       {sround('CAST(sum(CASE WHEN is_fraud_label THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100', 3)} AS fraud_rate_pct,
       {bround0(msum('amount_usd'))} AS gmv_usd,
       {bround0(msum('amount_usd', 'is_fraud_label'))} AS fraud_usd,
       count(DISTINCT CASE WHEN is_fraud_label THEN card_id END) AS compromised_cards,
       count(DISTINCT event_date) AS window_days,
       (SELECT count(*) FROM stg_chargebacks) AS chargebacks
FROM fct_transactions"""))
def agg_10(spark, sf_dir):
    p = _p(spark, sf_dir)
    return reports.kpi_headline(p.fact, p.silver["chargebacks"])


@register("agg_11_kpi_by_pattern", q(f"""
SELECT fraud_type_label AS fraud_type, count(*) AS count, {sround(msum('amount_usd'), 0)} AS usd
FROM fct_transactions WHERE is_fraud_label GROUP BY fraud_type_label ORDER BY count DESC, fraud_type"""))
def agg_11(spark, sf_dir):
    return reports.kpi_by_pattern(_p(spark, sf_dir).fact)


@register("agg_12_kpi_hourly_zero_filled", q(f"""
, per AS (SELECT event_hour, count(*) AS txns, {cnt('is_fraud_label')} AS fraud
          FROM fct_transactions GROUP BY event_hour)
SELECT CAST(h.event_hour AS INTEGER) AS event_hour, coalesce(per.txns, 0) AS txns, coalesce(per.fraud, 0) AS fraud,
       coalesce({sround('CAST(100.0 AS DOUBLE) * per.fraud / nullif(per.txns, 0)', 3)}, CAST(0 AS DOUBLE)) AS fraud_rate_pct
FROM (SELECT range AS event_hour FROM range(24)) h LEFT JOIN per ON h.event_hour = per.event_hour
ORDER BY event_hour"""))
def agg_12(spark, sf_dir):
    return reports.kpi_hourly(_p(spark, sf_dir).fact)


@register("agg_13_kpi_exposure", q(f"""
SELECT {bround0(msum('amount_usd', 'is_confirmed_fraud'))} AS confirmed_loss_usd,
       {bround0(msum('amount_usd', 'is_fraud_label AND NOT is_confirmed_fraud'))} AS outstanding_usd,
       {bround0(msum('amount_usd', 'NOT is_fraud_label AND is_confirmed_fraud'))} AS disputed_non_fraud_usd
FROM fct_transactions"""))
def agg_13(spark, sf_dir):
    return reports.kpi_exposure(_p(spark, sf_dir).fact)


@register("agg_14_kpi_feature_separation", q(f"""
SELECT is_fraud_label, {sround(msum('amount_usd') + ' / CAST(count(amount_usd) AS DOUBLE)', 2)} AS amount,
       {sround('avg(geo_distance_from_home_km)', 2)} AS geo_from_home_km,
       {sround('avg(geo_distance_from_prev_km)', 2)} AS geo_from_prev_km,
       {sround('avg(implied_speed_kmh)', 2)} AS implied_speed_kmh,
       {xmean('is_new_device * 100', 0, 2)} AS is_new_device_pct
FROM fct_transactions GROUP BY is_fraud_label"""))
def agg_14(spark, sf_dir):
    return reports.kpi_feature_separation(_p(spark, sf_dir).fact)


@register("agg_15_kpi_top_merchants", q(f"""
, per AS (SELECT merchant_id, count(*) AS txns, {cnt('is_fraud_label')} AS fraud, {msum('amount_usd')} AS gmv
          FROM fct_transactions GROUP BY merchant_id HAVING count(*) >= 20)
SELECT per.merchant_id, m.merchant_name AS name, m.merchant_category AS category, per.txns, per.fraud,
       {sround('CAST(per.fraud AS DOUBLE) / per.txns', 4)} AS observed_fraud_rate, m.baseline_fraud_rate
FROM per LEFT JOIN stg_merchants m ON per.merchant_id = m.merchant_id
ORDER BY observed_fraud_rate DESC, per.merchant_id LIMIT 12"""))
def agg_15(spark, sf_dir):
    p = _p(spark, sf_dir)
    return reports.kpi_top_merchants(p.fact, p.silver["merchants"])


# ---------------------------------------------------------------- set operations
@register("set_01_union_by_name", q("""
, hist AS (SELECT card_id, arg_max(event_ts, (event_ts, transaction_id)) AS event_ts,
                  arg_max(lat, (event_ts, transaction_id)) AS lat, arg_max(lon, (event_ts, transaction_id)) AS lon
           FROM stg_transactions GROUP BY card_id)
SELECT transaction_id, card_id, amount_usd, event_ts, lat, lon FROM stg_transactions
UNION ALL BY NAME
SELECT card_id, event_ts, lat, lon FROM hist"""))
def set_01(spark, sf_dir):
    from ..operators.features import last_per_key
    t = _p(spark, sf_dir).silver["transactions"]
    hist = last_per_key(t, "card_id", ["event_ts", "transaction_id"], ["event_ts", "lat", "lon"])
    batch = t.select("transaction_id", "card_id", "amount_usd", "event_ts", "lat", "lon")
    return ntz(batch.unionByName(hist, allowMissingColumns=True))
