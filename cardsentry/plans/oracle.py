"""DuckDB SQL that recomputes each registered query from the driver tables.

``BASE`` is the shared CTE prefix (raw tables as FIXTURES.md maps them, staging,
features, marts); DuckDB ignores CTEs a query does not use.  Features follow their
definitions row by row (``behaviour``), not the frames that Spark evaluates.
"""
from __future__ import annotations


def sround(expr: str, n: int) -> str:
    """Spark's ``round`` on DOUBLE rounds the shortest decimal form half-up;
    DuckDB rounds the binary value.  Going through text reproduces Spark."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
         f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    return f"(2 * 6371.0 * asin(sqrt(CASE WHEN {a} > 1.0 THEN 1.0 ELSE {a} END)))"


def msum(expr: str, cond: str | None = None) -> str:
    """Sum of the decimal forms of the doubles, which no order of rows changes."""
    v = f"CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,12))"
    if cond:
        v = f"CASE WHEN {cond} THEN {v} ELSE 0 END"
    return f"CAST(sum({v}) AS DOUBLE)"


def cnt(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def behaviour(txn: str, prefix: str = "") -> str:
    """CTEs ``<prefix>windowed`` and ``<prefix>features`` of the transactions ``txn``.

    Each frame is stated as an aggregate over the rows it covers, found by joins on
    the row's number within its card (amounts) and on its hour and the one before
    (velocity), so that nothing depends on an engine's window frames.
    """
    p, step = prefix, "coalesce(" + hav("w.lat", "w.lon", "w.prev_lat", "w.prev_lon") + ", CAST(0 AS DOUBLE))"
    return f"""
{p}card_rows AS (
  SELECT *, epoch_us(event_ts) // 1000000 AS epoch,
         row_number() OVER (PARTITION BY card_id ORDER BY event_ts, transaction_id) AS nth
  FROM {txn}),
{p}earlier_amounts AS (
  SELECT t.transaction_id, avg(e.amount_usd) AS card_amount_mean,
         CASE WHEN count(e.amount_usd) > 1 AND min(e.amount_usd) = max(e.amount_usd) THEN CAST(0 AS DOUBLE)
              ELSE stddev_samp(e.amount_usd) END AS card_amount_std
  FROM (SELECT transaction_id, card_id, nth, unnest(range(1, 51)) AS back FROM {p}card_rows) t
  JOIN {p}card_rows e ON e.card_id = t.card_id AND e.nth = t.nth - t.back
  GROUP BY t.transaction_id),
{p}last_hour AS (
  SELECT t.transaction_id, count(*) AS txn_count_1h, count(*) FILTER (e.epoch >= t.epoch - 60) AS txn_count_60s
  FROM (SELECT transaction_id, card_id, epoch, unnest([epoch // 3600 - 1, epoch // 3600]) AS hour_no FROM {p}card_rows) t
  JOIN {p}card_rows e ON e.card_id = t.card_id AND e.epoch // 3600 = t.hour_no AND e.epoch BETWEEN t.epoch - 3600 AND t.epoch
  GROUP BY t.transaction_id),
{p}windowed AS (
  SELECT t.*, b.event_ts AS prev_ts, t.epoch - b.epoch AS gap, b.lat AS prev_lat, b.lon AS prev_lon,
         a.card_amount_mean, a.card_amount_std, h.txn_count_60s, h.txn_count_1h
  FROM {p}card_rows t
  JOIN {p}last_hour h ON h.transaction_id = t.transaction_id
  LEFT JOIN {p}earlier_amounts a ON a.transaction_id = t.transaction_id
  LEFT JOIN {p}card_rows b ON b.card_id = t.card_id AND b.nth = t.nth - 1),
{p}features AS (
  SELECT w.transaction_id, w.card_id, w.merchant_id, c.account_id, m.merchant_category, w.event_ts, w.event_date,
         w.entry_mode, w.amount_usd, w.is_fraud_label, w.fraud_type_label,
         ln(1 + w.amount_usd) AS amount_log,
         coalesce(w.gap, 999999) AS seconds_since_prev,
         {hav('w.lat', 'w.lon', 'c.home_lat', 'c.home_lon')} AS geo_distance_from_home_km,
         {step} AS geo_distance_from_prev_km,
         CAST(coalesce(w.device_id <> c.primary_device_id, false) AS INTEGER) AS is_new_device,
         coalesce(m.baseline_fraud_rate, CAST(0 AS DOUBLE)) AS mcc_risk,
         CASE WHEN w.card_amount_std > 0 THEN (w.amount_usd - w.card_amount_mean) / w.card_amount_std
              ELSE CAST(0 AS DOUBLE) END AS amount_zscore,
         w.txn_count_60s, w.txn_count_1h,
         CASE WHEN w.gap > 0 THEN {step} / (w.gap / CAST(3600.0 AS DOUBLE)) ELSE CAST(0 AS DOUBLE) END AS implied_speed_kmh
  FROM {p}windowed w
  LEFT JOIN stg_cards c ON c.card_id = w.card_id
  LEFT JOIN stg_merchants m ON m.merchant_id = w.merchant_id)""".strip()


FRAUD = "(event_type = 'error' AND value > 100)"

_CATS = ["grocery", "restaurant", "fuel", "online_retail", "electronics", "travel",
         "entertainment", "pharmacy", "apparel", "crypto_exchange", "gambling", "money_transfer"]
_FT = ["card_testing", "account_takeover", "geo_impossible", "amount_anomaly", "merchant_collusion"]


def _case(expr: str, values: list[str]) -> str:
    return "CASE " + expr + " " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


BASE = f"""
raw_transactions AS (
  SELECT event_id AS transaction_id, user_id AS card_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS merchant_id,
         value AS amount, 'USD' AS currency,
         CAST(ts AS TIMESTAMP) AS ts, CAST(ts AS DATE) AS event_date,
         CAST(-50 + (user_id * 37) % 100 AS DOUBLE)
           + CASE WHEN {FRAUD} THEN CAST(25.0 AS DOUBLE) ELSE CAST(event_id % 19 - 9 AS DOUBLE) / CAST(100.0 AS DOUBLE) END AS lat,
         CAST(-120 + (user_id * 53) % 240 AS DOUBLE)
           + CASE WHEN {FRAUD} THEN CAST(40.0 AS DOUBLE) ELSE CAST(event_id % 23 - 11 AS DOUBLE) / CAST(100.0 AS DOUBLE) END AS lon,
         CASE WHEN {FRAUD} OR event_id % 33 = 0 THEN 'X' || CAST(event_id AS VARCHAR)
              ELSE 'D' || CAST(user_id AS VARCHAR) END AS device_id,
         CASE event_type WHEN 'view' THEN 'chip' WHEN 'click' THEN 'contactless'
                         WHEN 'signup' THEN 'swipe' ELSE 'online' END AS entry_mode,
         {FRAUD} AS is_fraud,
         CASE WHEN {FRAUD} THEN {_case('event_id % 5', _FT)} END AS fraud_type
  FROM events),
raw_cards AS (
  SELECT c.c_custkey AS card_id, CAST(floor(c.c_custkey / 2) AS BIGINT) AS account_id,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'credit' ELSE 'debit' END AS card_type,
         CAST(DATE '2023-01-01' + CAST(c.c_custkey % 300 AS INTEGER) AS DATE) AS issue_date,
         'D' || CAST(c.c_custkey AS VARCHAR) AS primary_device_id,
         CAST(-50 + (c.c_custkey * 37) % 100 AS DOUBLE) AS home_lat,
         CAST(-120 + (c.c_custkey * 53) % 240 AS DOUBLE) AS home_lon,
         n.n_name AS home_country, c.c_acctbal >= 0 AS is_active
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
raw_accounts AS (
  SELECT CAST(floor(c.c_custkey / 2) AS BIGINT) AS account_id,
         CAST(DATE '2022-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS DATE) AS signup_date,
         n.n_name AS home_country,
         CASE c.c_mktsegment WHEN 'BUILDING' THEN 'high' WHEN 'FURNITURE' THEN 'medium' ELSE 'low' END AS risk_band
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE c.c_custkey % 2 = 0),
raw_merchants AS (
  SELECT s.s_suppkey AS merchant_id, s.s_name AS name, {_case('s.s_suppkey % 12', _CATS)} AS category,
         n.n_name AS country,
         CAST(-40 + (s.s_suppkey * 31) % 80 AS DOUBLE) AS lat,
         CAST(-100 + (s.s_suppkey * 41) % 200 AS DOUBLE) AS lon,
         CASE WHEN s.s_suppkey % 12 IN (4, 9, 10, 11) THEN CAST(0.06 AS DOUBLE) ELSE CAST(0.004 AS DOUBLE) END
           * CAST(5 + s.s_suppkey % 14 AS DOUBLE) / CAST(10.0 AS DOUBLE) AS baseline_fraud_rate
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
raw_auth_events AS (
  SELECT transaction_id, approved,
         CASE WHEN approved THEN 'approved' WHEN is_fraud THEN 'risk_block' ELSE 'do_not_honor' END AS reason,
         ts AS auth_ts, event_date
  FROM (SELECT *, NOT ((is_fraud AND transaction_id % 20 < 7) OR (NOT is_fraud AND transaction_id % 100 < 3)) AS approved
        FROM raw_transactions WHERE transaction_id % 50 <> 49)),
raw_chargebacks AS (
  SELECT 'CB' || CAST(transaction_id AS VARCHAR) AS chargeback_id, transaction_id, amount,
         CASE WHEN is_fraud THEN 'fraud' ELSE 'dispute' END AS reason_code,
         ts + to_days(CAST(10 + transaction_id % 36 AS INTEGER)) AS settle_ts,
         CAST(ts + to_days(CAST(10 + transaction_id % 36 AS INTEGER)) AS DATE) AS settle_date
  FROM raw_transactions
  WHERE (is_fraud AND transaction_id % 5 <> 4) OR (NOT is_fraud AND transaction_id % 625 = 0)),
live_fraud_alerts AS (
  SELECT transaction_id, card_id, merchant_id, amount, ts AS event_ts,
         least(CAST(1.0 AS DOUBLE), amount / CAST(300.0 AS DOUBLE)) AS fraud_score,
         least(CAST(1.0 AS DOUBLE), amount / CAST(300.0 AS DOUBLE)) >= 0.5 AS is_alert
  FROM raw_transactions),
stg_transactions AS (
  SELECT transaction_id, card_id, merchant_id, CAST(amount AS DOUBLE) AS amount_usd, currency,
         CAST(ts AS TIMESTAMP) AS event_ts, CAST(event_date AS DATE) AS event_date,
         CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, device_id, entry_mode,
         CAST(is_fraud AS BOOLEAN) AS is_fraud_label, fraud_type AS fraud_type_label
  FROM raw_transactions),
stg_auth_events AS (
  SELECT transaction_id, CAST(approved AS BOOLEAN) AS is_approved, reason AS decline_reason,
         CAST(auth_ts AS TIMESTAMP) AS auth_ts
  FROM raw_auth_events),
stg_chargebacks AS (
  SELECT chargeback_id, transaction_id, CAST(amount AS DOUBLE) AS chargeback_amount, reason_code,
         CAST(settle_ts AS TIMESTAMP) AS settle_ts, CAST(settle_date AS DATE) AS settle_date
  FROM raw_chargebacks),
stg_accounts AS (
  SELECT account_id, CAST(signup_date AS DATE) AS signup_date, home_country, risk_band FROM raw_accounts),
stg_cards AS (
  SELECT card_id, account_id, card_type, CAST(issue_date AS DATE) AS issue_date, primary_device_id,
         CAST(home_lat AS DOUBLE) AS home_lat, CAST(home_lon AS DOUBLE) AS home_lon, home_country,
         CAST(is_active AS BOOLEAN) AS is_active
  FROM raw_cards),
stg_merchants AS (
  SELECT merchant_id, name AS merchant_name, category AS merchant_category, country AS merchant_country,
         CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon,
         CAST(baseline_fraud_rate AS DOUBLE) AS baseline_fraud_rate
  FROM raw_merchants),
{behaviour('stg_transactions')},
first_cb AS (
  SELECT transaction_id, arg_min(reason_code, (settle_ts, chargeback_id)) AS chargeback_reason
  FROM stg_chargebacks GROUP BY transaction_id),
fct_transactions AS (
  SELECT e.transaction_id, e.card_id, e.merchant_id, e.account_id, e.merchant_category, e.event_ts,
         e.event_date, CAST(hour(e.event_ts) AS INTEGER) AS event_hour, e.entry_mode, e.amount_usd,
         e.amount_log, e.seconds_since_prev, e.geo_distance_from_home_km, e.geo_distance_from_prev_km,
         e.is_new_device, e.mcc_risk, e.amount_zscore, e.txn_count_60s, e.txn_count_1h, e.implied_speed_kmh,
         coalesce(a.is_approved, true) AS is_approved, a.decline_reason,
         c.transaction_id IS NOT NULL AS is_confirmed_fraud, c.chargeback_reason,
         e.is_fraud_label, e.fraud_type_label
  FROM features e
  LEFT JOIN stg_auth_events a ON e.transaction_id = a.transaction_id
  LEFT JOIN first_cb c ON e.transaction_id = c.transaction_id),
dim_merchant AS (
  SELECT merchant_id, merchant_name, merchant_category, merchant_country, baseline_fraud_rate,
         CASE WHEN merchant_category IN ('crypto_exchange', 'gambling', 'money_transfer') THEN 'high'
              WHEN merchant_category IN ('electronics', 'travel') THEN 'medium' ELSE 'low' END AS risk_tier
  FROM stg_merchants),
agg_fraud_by_hour AS (
  SELECT event_date, event_hour, count(*) AS txn_count, {msum('amount_usd')} AS gmv_usd,
         {cnt('is_fraud_label')} AS fraud_count,
         {msum('amount_usd', 'is_fraud_label')} AS fraud_usd,
         {msum('amount_usd', 'is_confirmed_fraud')} AS chargeback_usd,
         {cnt('NOT is_approved')} AS declined_count,
         {sround("CAST(100.0 AS DOUBLE) * sum(CASE WHEN is_fraud_label THEN 1 ELSE 0 END) / count(*)", 4)} AS fraud_rate_pct
  FROM fct_transactions GROUP BY event_date, event_hour),
agg_merchant_risk AS (
  SELECT m.merchant_id, m.merchant_name, m.merchant_category, m.risk_tier, m.baseline_fraud_rate,
         count(*) AS txn_count, {msum('f.amount_usd')} AS gmv_usd, {cnt('f.is_fraud_label')} AS fraud_count,
         {sround("CAST(sum(CASE WHEN f.is_fraud_label THEN 1 ELSE 0 END) AS DOUBLE) / count(*)", 4)} AS observed_fraud_rate,
         {msum('f.amount_usd', 'f.is_confirmed_fraud')} AS chargeback_usd
  FROM fct_transactions f JOIN dim_merchant m ON f.merchant_id = m.merchant_id
  GROUP BY 1, 2, 3, 4, 5),
mart_chargeback_exposure AS (
  SELECT event_date,
         {msum('amount_usd', 'is_confirmed_fraud')} AS confirmed_loss_usd,
         {msum('amount_usd', 'is_fraud_label AND NOT is_confirmed_fraud')} AS outstanding_exposure_usd,
         {msum('amount_usd', 'NOT is_fraud_label AND is_confirmed_fraud')} AS disputed_non_fraud_usd,
         count(CASE WHEN is_confirmed_fraud THEN 1 END) AS chargeback_count
  FROM fct_transactions GROUP BY event_date),
mart_model_performance AS (
  SELECT event_date, count(*) AS scored_txns,
         {cnt('is_alert AND is_fraud_label')} AS true_positives,
         {cnt('is_alert AND NOT is_fraud_label')} AS false_positives,
         {cnt('NOT is_alert AND is_fraud_label')} AS false_negatives,
         {sround("CAST(sum(CASE WHEN is_alert AND is_fraud_label THEN 1 ELSE 0 END) AS DOUBLE) / nullif(sum(CASE WHEN is_alert THEN 1 ELSE 0 END), 0)", 4)} AS precision,
         {sround("CAST(sum(CASE WHEN is_alert AND is_fraud_label THEN 1 ELSE 0 END) AS DOUBLE) / nullif(sum(CASE WHEN is_fraud_label THEN 1 ELSE 0 END), 0)", 4)} AS recall
  FROM (SELECT l.event_date, l.is_fraud_label, s.is_alert, s.fraud_score
        FROM fct_transactions l JOIN live_fraud_alerts s ON l.transaction_id = s.transaction_id)
  GROUP BY event_date)
"""


def q(select_sql: str) -> str:
    return "WITH " + BASE.strip() + "\n" + select_sql


def xmean(expr: str, in_scale: int, out_scale: int) -> str:
    """Exact half-up rounded mean of a fixed-point quantity (see
    ``cardsentry.functions.expr.rounded_mean``)."""
    u = f"CAST(round(({expr}) * {10 ** in_scale}) AS BIGINT)"
    s, n = f"CAST(sum({u}) AS HUGEINT)", f"CAST(count({u}) AS HUGEINT)"
    if out_scale >= in_scale:
        num, den = f"({s} * {10 ** (out_scale - in_scale)})", n
    else:
        num, den = s, f"({n} * {10 ** (in_scale - out_scale)})"
    q = f"(((abs({num}) * 2 + {den}) // ({den} * 2)) * sign({num}))"
    return f"CASE WHEN {n} > 0 THEN CAST({q} AS DOUBLE) / CAST({10 ** out_scale} AS DOUBLE) END"


def bround0(expr: str) -> str:
    """Half-even rounding to an integer (exact for cent-valued inputs)."""
    return f"round_even(CAST(({expr}) AS DECIMAL(38,2)), 0)::DOUBLE"
