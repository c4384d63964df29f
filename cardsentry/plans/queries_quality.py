"""Data-quality checks: single checks on clean and seeded data, and the suite."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as dq
from ..operators.features import FEATURES
from ..session import checkpoint_dir
from .catalog import register
from .context import Pipeline, ntz
from .oracle import q
from .queries_scd import DIM_CARD_SQL

FRESHNESS_AS_OF = "2024-01-31 06:00:00"


def _p(spark, sf_dir):
    return Pipeline.get(spark, sf_dir)


def suite_tables(p: Pipeline, fact=None) -> dict:
    """Tables the suite checks.  ``fact`` (materialised by the caller) feeds
    the fact checks and the marts, so the feature windows run once."""
    from ..operators import gold
    fact = p.fact if fact is None else fact
    t = {f"raw_{k}": v for k, v in p.raw.items()}
    t.update({f"stg_{k}": v for k, v in p.silver.items()})
    t.update({"fct_transactions": fact, "dim_merchant": p.dim_merchant, "dim_card": p.dim_card,
              "agg_fraud_by_hour": gold.agg_fraud_by_hour(fact),
              "agg_merchant_risk": gold.agg_merchant_risk(fact, p.dim_merchant),
              "mart_model_performance": gold.mart_model_performance(fact, p.alerts)})
    return t


def suite_custom(p: Pipeline, fact=None) -> dict:
    return dq.invariants(p.silver, p.fact if fact is None else fact)


# ---------------------------------------------------------------- oracle for the suite
def _sql_check(c: dq.Check) -> str:
    name, t, col = c.name, c.table, c.column
    if c.kind == "not_null":
        return f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE {col} IS NULL) AS violations FROM {t}"
    if c.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in c.values)
        return (f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE coalesce({col} NOT IN ({vals}), false))"
                f" AS violations FROM {t}")
    if c.kind == "accepted_range":
        conds = []
        if c.min_value is not None:
            conds.append(f"{col} {'>=' if c.inclusive else '>'} {c.min_value}")
        if c.max_value is not None:
            conds.append(f"{col} {'<=' if c.inclusive else '<'} {c.max_value}")
        return (f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE coalesce(NOT ({' AND '.join(conds)}), false))"
                f" AS violations FROM {t}")
    if c.kind == "expression":
        return f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE coalesce({c.condition}, true)) AS violations FROM {t}"
    if c.kind == "unique":
        return (f"SELECT '{name}' AS check_name, count(*) AS violations FROM (SELECT {col} FROM {t}"
                f" WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)")
    if c.kind == "relationships":
        return (f"SELECT '{name}' AS check_name, count(*) AS violations FROM {t} x WHERE x.{col} IS NOT NULL"
                f" AND NOT EXISTS (SELECT 1 FROM {c.to_table} y WHERE y.{c.to_column} = x.{col})")
    raise ValueError(c.kind)


_CUSTOM_SQL = {
    "assert_fraud_rate_plausible": ("fct_transactions", "error", """SELECT count(*) FROM (
        SELECT count(*) AS n, sum(CASE WHEN is_fraud_label THEN 1 ELSE 0 END) AS fraud FROM fct_transactions)
        WHERE CAST(fraud AS DOUBLE) / n > 0.05 OR fraud = 0"""),
    "assert_no_chargeback_before_transaction": ("stg_chargebacks", "error", """SELECT count(*)
        FROM stg_chargebacks cb JOIN stg_transactions t ON cb.transaction_id = t.transaction_id
        WHERE cb.settle_ts < t.event_ts"""),
    "every_transaction_has_auth": ("stg_transactions", "warn", """SELECT count(*) FROM stg_transactions t
        WHERE NOT EXISTS (SELECT 1 FROM stg_auth_events a WHERE a.transaction_id = t.transaction_id)"""),
    "chargebacks_reference_earlier_transactions": ("stg_chargebacks", "error", """SELECT count(*)
        FROM stg_chargebacks cb LEFT JOIN stg_transactions t ON cb.transaction_id = t.transaction_id
        WHERE t.event_ts IS NULL OR cb.settle_ts <= t.event_ts"""),
}


def suite_sql() -> str:
    checks = dq.default_checks()
    body = "\nUNION ALL\n".join(
        [f"SELECT check_name, '{c.table}' AS table_name, '{c.kind}' AS kind, '{c.severity}' AS severity,"
         f" CAST(violations AS BIGINT) AS violations FROM ({_sql_check(c)})" for c in checks]
        + [f"SELECT '{n}', '{t}', 'custom', '{sev}', CAST(({sql}) AS BIGINT)" for n, (t, sev, sql) in _CUSTOM_SQL.items()])
    return q(DIM_CARD_SQL + f""", suite AS ({body})
SELECT check_name, table_name, kind, violations,
       CASE WHEN violations = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
FROM suite""")


@register("dq_13_suite", suite_sql())
def dq_13(spark, sf_dir):
    p = _p(spark, sf_dir)
    # The fact feeds a dozen checks and three marts: materialise it once in
    # the shared checkpoint folder (reliable checkpoint, survives executor loss).
    checkpoint_dir(spark)
    fact = p.fact.checkpoint(eager=True)
    return dq.run_suite(suite_tables(p, fact), dq.default_checks(), suite_custom(p, fact))


# ---------------------------------------------------------------- single checks, seeded
@register("dq_01_not_null_seeded", q("""
SELECT transaction_id FROM (
  SELECT transaction_id, CASE WHEN transaction_id % 97 = 0 THEN NULL ELSE merchant_id END AS merchant_id
  FROM stg_transactions) WHERE merchant_id IS NULL"""))
def dq_01(spark, sf_dir):
    t = _p(spark, sf_dir).silver["transactions"]
    seeded = t.withColumn("merchant_id", F.when(F.col("transaction_id") % 97 == 0, F.lit(None))
                          .otherwise(F.col("merchant_id")))
    return dq.not_null(seeded, "merchant_id").select("transaction_id")


@register("dq_02_unique_seeded", q("""
SELECT transaction_id, count(*) AS n_records FROM (
  SELECT transaction_id FROM stg_transactions
  UNION ALL SELECT transaction_id FROM stg_transactions WHERE transaction_id % 101 = 0)
GROUP BY transaction_id HAVING count(*) > 1"""))
def dq_02(spark, sf_dir):
    t = _p(spark, sf_dir).silver["transactions"].select("transaction_id")
    return dq.unique(t.unionByName(t.filter(F.col("transaction_id") % 101 == 0)), "transaction_id")


@register("dq_03_relationships_seeded", q("""
SELECT transaction_id, card_id FROM (
  SELECT transaction_id, CASE WHEN transaction_id % 89 = 0 THEN card_id + 1000000000 ELSE card_id END AS card_id
  FROM stg_transactions) x
WHERE NOT EXISTS (SELECT 1 FROM stg_cards c WHERE c.card_id = x.card_id)"""))
def dq_03(spark, sf_dir):
    s = _p(spark, sf_dir).silver
    t = s["transactions"].select(
        "transaction_id",
        F.when(F.col("transaction_id") % 89 == 0, F.col("card_id") + 1000000000).otherwise(F.col("card_id"))
         .alias("card_id"))
    return dq.relationships(t, "card_id", s["cards"], "card_id")


@register("dq_04_accepted_values_seeded", q("""
SELECT transaction_id, entry_mode FROM (
  SELECT transaction_id, CASE WHEN transaction_id % 83 = 0 THEN 'magstripe' ELSE entry_mode END AS entry_mode
  FROM stg_transactions) WHERE entry_mode NOT IN ('chip', 'contactless', 'swipe', 'online')"""))
def dq_04(spark, sf_dir):
    t = _p(spark, sf_dir).silver["transactions"].select(
        "transaction_id",
        F.when(F.col("transaction_id") % 83 == 0, F.lit("magstripe")).otherwise(F.col("entry_mode")).alias("entry_mode"))
    return dq.accepted_values(t, "entry_mode", dq.ENTRY_MODES)


@register("dq_05_accepted_range_seeded", q("""
SELECT transaction_id, amount_usd FROM (
  SELECT transaction_id, amount_usd - CAST(5.0 AS DOUBLE) AS amount_usd FROM stg_transactions)
WHERE NOT (amount_usd > 0)"""))
def dq_05(spark, sf_dir):
    t = _p(spark, sf_dir).silver["transactions"].select(
        "transaction_id", (F.col("amount_usd") - 5.0).alias("amount_usd"))
    return dq.accepted_range(t, "amount_usd", min_value=0, inclusive=False)


@register("dq_06_freshness", q(f"""
SELECT 'stg_transactions' AS table_name, max(event_ts) AS max_loaded_at,
       round((epoch(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch(max(event_ts)) // 1) / 3600.0, 3) AS age_hours,
       CASE WHEN max(event_ts) IS NULL OR (epoch(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch(max(event_ts)) // 1) / 3600.0 > 24 THEN 'error'
            WHEN (epoch(TIMESTAMP '{FRESHNESS_AS_OF}') - epoch(max(event_ts)) // 1) / 3600.0 > 12 THEN 'warn'
            ELSE 'pass' END AS status
FROM stg_transactions"""))
def dq_06(spark, sf_dir):
    t = _p(spark, sf_dir).silver["transactions"]
    return ntz(dq.freshness(t, "event_ts", FRESHNESS_AS_OF, 12, 24, table="stg_transactions"))


@register("dq_07_features_not_null", q(
    "SELECT transaction_id FROM fct_transactions WHERE " + " OR ".join(f"{c} IS NULL" for c in FEATURES)))
def dq_07(spark, sf_dir):
    return dq.features_not_null(_p(spark, sf_dir).fact, FEATURES)


@register("dq_08_fraud_rate_plausible", q("""
SELECT n, fraud, rate FROM (
  SELECT count(*) AS n, CAST(sum(CASE WHEN is_fraud_label THEN 1 ELSE 0 END) AS BIGINT) AS fraud,
         CAST(sum(CASE WHEN is_fraud_label THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS rate
  FROM fct_transactions) WHERE rate > 0.05 OR fraud = 0"""))
def dq_08(spark, sf_dir):
    return dq.fraud_rate_plausible(_p(spark, sf_dir).fact)


@register("dq_09_chargeback_before_txn_seeded", q("""
SELECT cb.chargeback_id, cb.settle_ts, t.event_ts
FROM (SELECT chargeback_id, transaction_id,
             CASE WHEN transaction_id % 3 = 0 THEN settle_ts - INTERVAL 60 DAY ELSE settle_ts END AS settle_ts
      FROM stg_chargebacks) cb
JOIN stg_transactions t ON cb.transaction_id = t.transaction_id WHERE cb.settle_ts < t.event_ts"""))
def dq_09(spark, sf_dir):
    s = _p(spark, sf_dir).silver
    cb = s["chargebacks"].withColumn(
        "settle_ts", F.when(F.col("transaction_id") % 3 == 0, F.col("settle_ts") - F.expr("INTERVAL 60 DAYS"))
        .otherwise(F.col("settle_ts")))
    return ntz(dq.chargeback_before_transaction(cb, s["transactions"]))


@register("dq_10_transaction_has_auth", q("""
SELECT transaction_id FROM stg_transactions t
WHERE NOT EXISTS (SELECT 1 FROM stg_auth_events a WHERE a.transaction_id = t.transaction_id)"""))
def dq_10(spark, sf_dir):
    s = _p(spark, sf_dir).silver
    return dq.missing_auth(s["transactions"], s["auth_events"])


@register("dq_11_chargeback_integrity", q("""
SELECT cb.chargeback_id, cb.transaction_id FROM stg_chargebacks cb
LEFT JOIN stg_transactions t ON cb.transaction_id = t.transaction_id
WHERE t.event_ts IS NULL OR cb.settle_ts <= t.event_ts"""))
def dq_11(spark, sf_dir):
    s = _p(spark, sf_dir).silver
    return dq.chargeback_integrity(s["chargebacks"], s["transactions"])


@register("dq_12_value_domains", q(
    f"SELECT transaction_id FROM stg_transactions WHERE coalesce({dq.VALUE_DOMAIN_VIOLATION}, true)"))
def dq_12(spark, sf_dir):
    return dq.value_domains(_p(spark, sf_dir).silver["transactions"])


# ---------------------------------------------------------------- invariants, seeded
@register("dq_07b_features_not_null_seeded", q("SELECT transaction_id FROM fct_transactions WHERE transaction_id % 103 = 0"))
def dq_07b(spark, sf_dir):
    fact = _p(spark, sf_dir).fact
    return dq.features_not_null(fact.withColumn("mcc_risk", F.when(F.col("transaction_id") % 103 != 0, F.col("mcc_risk"))), FEATURES)


@register("dq_08b_fraud_rate_seeded", q("""
SELECT count(*) AS n, CAST(count(*) FILTER (WHERE transaction_id % 8 = 0) AS BIGINT) AS fraud,
       CAST(count(*) FILTER (WHERE transaction_id % 8 = 0) AS DOUBLE) / count(*) AS rate
FROM fct_transactions"""))
def dq_08b(spark, sf_dir):
    return dq.fraud_rate_plausible(_p(spark, sf_dir).fact.withColumn("is_fraud_label", F.col("transaction_id") % 8 == 0))


@register("dq_11b_chargeback_integrity_seeded", q("""
SELECT chargeback_id, transaction_id + CASE WHEN transaction_id % 3 = 0 THEN 1000000000 ELSE 0 END AS transaction_id
FROM stg_chargebacks WHERE transaction_id % 3 = 0 OR transaction_id % 3 = 1 AND transaction_id % 2 = 0"""))
def dq_11b(spark, sf_dir):
    """Chargebacks of unknown transactions, and some that settle with their transaction."""
    s, tid = _p(spark, sf_dir).silver, F.col("transaction_id")
    txn = s["transactions"].select(tid.alias("t"), "event_ts")
    early = (tid % 3 == 1) & (tid % 2 == 0)
    cb = (s["chargebacks"].join(txn, F.col("t") == tid).withColumn("settle_ts", F.when(early, F.col("event_ts")).otherwise(F.col("settle_ts"))).drop("t", "event_ts")
          .withColumn("transaction_id", F.when(tid % 3 == 0, tid + 1000000000).otherwise(tid)))
    return dq.chargeback_integrity(cb, s["transactions"])


@register("dq_12b_value_domains_seeded", q("SELECT transaction_id FROM stg_transactions WHERE transaction_id % 107 = 0 OR transaction_id % 109 = 0"))
def dq_12b(spark, sf_dir):
    t, tid = _p(spark, sf_dir).silver["transactions"], F.col("transaction_id")
    return dq.value_domains(t.withColumns({"lat": F.when(tid % 107 == 0, F.lit(120.0)).otherwise(F.col("lat")), "entry_mode": F.when(tid % 109 == 0, F.lit(None)).otherwise(F.col("entry_mode"))}))
