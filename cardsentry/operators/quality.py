"""Data-quality checks.

Each check returns a DataFrame of violations (no rows = pass).  The suite
runner evaluates a declarative list of checks with one aggregation per table
for all row-level checks (one scan per table, map-side combined), and one shuffle
for all uniqueness and relationship checks together, and returns one row per
check: (check_name, table_name, kind, violations, status).
"""
from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expr import count_if


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    kind: str                      # not_null | unique | relationships | accepted_values | accepted_range | expression
    column: str | None = None
    values: tuple = field(default_factory=tuple)
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True
    to_table: str | None = None
    to_column: str | None = None
    condition: str | None = None   # expression kind: SQL predicate true for a violating row
    severity: str = "error"


# ---------------------------------------------------------------- single checks
def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Duplicated non-null key values with their multiplicity."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-null key has no parent (anti join)."""
    p = parent.select(F.col(parent_col).alias(col))
    return child.filter(F.col(col).isNotNull()).join(p, col, "left_anti")


def _values_violation(col: str, values) -> Column:
    return ~F.col(col).isin(list(values))


def accepted_values(df: DataFrame, col: str, values) -> DataFrame:
    return df.filter(_values_violation(col, values))


def _range_violation(col: str, min_value=None, max_value=None, inclusive=True) -> Column:
    c = F.col(col)
    conds = []
    if min_value is not None:
        conds.append(c >= min_value if inclusive else c > min_value)
    if max_value is not None:
        conds.append(c <= max_value if inclusive else c < max_value)
    return ~reduce(lambda a, b: a & b, conds)


def accepted_range(df: DataFrame, col: str, min_value=None, max_value=None, inclusive=True) -> DataFrame:
    return df.filter(_range_violation(col, min_value, max_value, inclusive))


def freshness(df: DataFrame, loaded_at: str, as_of, warn_after_hours: float = 12,
              error_after_hours: float = 24, table: str = "") -> DataFrame:
    """Source freshness against an explicit ``as_of`` (never the wall clock)."""
    t = F.lit(as_of).cast("timestamp")
    last = F.max(loaded_at)
    age = (F.unix_timestamp(t) - F.unix_timestamp(last)) / 3600.0
    return df.agg(last.alias("max_loaded_at"), age.alias("age_hours")).select(
        F.lit(table).alias("table_name"), "max_loaded_at", F.round("age_hours", 3).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull() | (F.col("age_hours") > error_after_hours), F.lit("error"))
         .when(F.col("age_hours") > warn_after_hours, F.lit("warn"))
         .otherwise(F.lit("pass")).alias("status"))


def features_not_null(fact: DataFrame, features: list[str]) -> DataFrame:
    return fact.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in features])) \
               .select("transaction_id")


def fraud_rate_plausible(fact: DataFrame, max_rate: float = 0.05) -> DataFrame:
    s = fact.agg(F.count(F.lit(1)).alias("n"), count_if(F.col("is_fraud_label")).alias("fraud"))
    s = s.withColumn("rate", F.col("fraud") / F.col("n"))
    return s.filter((F.col("rate") > max_rate) | (F.col("fraud") == 0))


def chargeback_before_transaction(chargebacks: DataFrame, txn: DataFrame) -> DataFrame:
    t = txn.select("transaction_id", "event_ts")
    return (chargebacks.select("chargeback_id", "transaction_id", "settle_ts").join(t, "transaction_id")
            .filter(F.col("settle_ts") < F.col("event_ts"))
            .select("chargeback_id", "settle_ts", "event_ts"))


def missing_auth(txn: DataFrame, auth: DataFrame) -> DataFrame:
    return txn.select("transaction_id").join(auth.select("transaction_id"), "transaction_id", "left_anti")


def chargeback_integrity(chargebacks: DataFrame, txn: DataFrame) -> DataFrame:
    """Chargebacks that reference no transaction or do not settle after it."""
    t = txn.select("transaction_id", "event_ts")
    j = chargebacks.select("chargeback_id", "transaction_id", "settle_ts").join(t, "transaction_id", "left")
    return j.filter(F.col("event_ts").isNull() | (F.col("settle_ts") <= F.col("event_ts"))) \
            .select("chargeback_id", "transaction_id")


# Allowed entry modes and merchant risk tiers.
ENTRY_MODES = ("chip", "contactless", "swipe", "online")
RISK_TIERS = ("low", "medium", "high")

VALUE_DOMAIN_VIOLATION = (
    "NOT (amount_usd > 0 AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180"
    " AND entry_mode IN ('chip', 'contactless', 'swipe', 'online')"
    " AND (is_fraud_label = (fraud_type_label IS NOT NULL)))")


def value_domains(txn: DataFrame) -> DataFrame:
    return txn.filter(F.coalesce(F.expr(VALUE_DOMAIN_VIOLATION), F.lit(True))).select("transaction_id")


def invariants(silver: dict[str, DataFrame], fact: DataFrame) -> dict[str, tuple[str, DataFrame, str]]:
    """The invariants over several tables, as ``run_suite`` takes them."""
    cb, txn = silver["chargebacks"], silver["transactions"]
    return {
        "assert_fraud_rate_plausible": ("fct_transactions", fraud_rate_plausible(fact), "error"),
        "assert_no_chargeback_before_transaction": ("stg_chargebacks", chargeback_before_transaction(cb, txn), "error"),
        "every_transaction_has_auth": ("stg_transactions", missing_auth(txn, silver["auth_events"]), "warn"),
        "chargebacks_reference_earlier_transactions": ("stg_chargebacks", chargeback_integrity(cb, txn), "error"),
    }


# ---------------------------------------------------------------- suite
def union_all(parts: list[DataFrame]) -> DataFrame:
    """Positional UNION ALL of same-layout frames, built as a balanced tree."""
    while len(parts) > 1:
        parts = [parts[i].union(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def _lit_sql(v) -> str:
    return f"'{v}'" if isinstance(v, str) else repr(v)


def row_violation_sql(c: Check) -> str:
    """SQL predicate, true for a row violating a row-level check.  Kept as
    text so a suite of many checks costs one expression parse per check."""
    col = f"`{c.column}`" if c.column else None
    if c.kind == "not_null":
        return f"{col} IS NULL"
    if c.kind == "accepted_values":
        return f"coalesce({col} NOT IN ({', '.join(_lit_sql(v) for v in c.values)}), false)"
    if c.kind == "accepted_range":
        conds = []
        if c.min_value is not None:
            conds.append(f"{col} {'>=' if c.inclusive else '>'} {_lit_sql(c.min_value)}")
        if c.max_value is not None:
            conds.append(f"{col} {'<=' if c.inclusive else '<'} {_lit_sql(c.max_value)}")
        return f"coalesce(NOT ({' AND '.join(conds)}), false)"
    if c.kind == "expression":
        return f"coalesce({c.condition}, true)"
    raise ValueError(c.kind)


ROW_KINDS = {"not_null", "accepted_values", "accepted_range", "expression"}


def key_counts(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """(check_name, violations) of uniqueness and relationship checks: the keys of all
    of them as rows tagged with their check, one scan of each table, counted in one
    shuffle (map-side combined, so a key that repeats is one row a task)."""
    asked: dict[str, list] = {}
    for i, c in enumerate(checks):
        asked.setdefault(c.table, []).append(F.struct(F.lit(i).alias("i"), F.col(c.column).cast("string").alias("key"), F.lit(1).cast("bigint").alias("n"), F.lit(0).alias("parent")))
        if c.kind == "relationships":
            asked.setdefault(c.to_table, []).append(F.struct(F.lit(i).alias("i"), F.col(c.to_column).cast("string").alias("key"), F.lit(0).cast("bigint").alias("n"), F.lit(1).alias("parent")))
    keys = union_all([tables[t].select(F.explode(F.array(*marks)).alias("k")).select("k.*").where("key is not null") for t, marks in asked.items()])
    per = keys.groupBy("i", "key").agg(F.sum("n").alias("n"), F.max("parent").alias("parent"))
    alone = F.col("i").isin([i for i, c in enumerate(checks) if c.kind == "unique"])
    found = F.when(alone, (F.col("n") > 1).cast("bigint")).otherwise(F.when(F.col("parent") == 0, F.col("n")).otherwise(F.lit(0)))
    names = F.array(*[F.lit(c.name) for c in checks])
    return per.groupBy("i").agg(F.sum(found).alias("violations")).select(F.element_at(names, F.col("i") + 1).alias("check_name"), "violations")


def violating_rows(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """(check_name, table_name, row as JSON) of the rows that row-level checks reject."""
    parts = []
    for t in dict.fromkeys(c.table for c in checks if c.kind in ROW_KINDS):
        broken = F.array_compact(F.array(*[F.when(F.expr(row_violation_sql(c)), F.lit(c.name)) for c in checks if c.table == t and c.kind in ROW_KINDS]))
        rows = tables[t].select(broken.alias("_broken"), F.to_json(F.struct(*tables[t].columns)).alias("row"))
        parts.append(rows.select(F.explode("_broken").alias("check_name"), F.lit(t).alias("table_name"), "row"))
    return union_all(parts)


def run_suite(tables: dict[str, DataFrame], checks: list[Check],
              custom: dict[str, tuple[str, DataFrame, str]] | None = None) -> DataFrame:
    """``custom`` maps check name -> (table name, violations DataFrame, severity)
    for multi-table invariants; their violations are the row counts."""
    custom = custom or {}
    absent = {t for c in checks for t in (c.table, c.to_table) if t is not None} - set(tables.keys())
    if absent:
        raise KeyError(f"checks name tables that are absent: {sorted(absent)}")
    checks = list(checks) + [Check(n, t, "custom", severity=sev) for n, (t, _, sev) in custom.items()]
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind in ROW_KINDS:
            by_table.setdefault(c.table, []).append(c)
    for t, cs in by_table.items():
        # all row-level checks of a table in one scan and one aggregate
        agg = tables[t].selectExpr(*[f"CAST(count_if({row_violation_sql(c)}) AS BIGINT) AS c{i}"
                                     for i, c in enumerate(cs)])
        stack = ", ".join(f"'{c.name}', c{i}" for i, c in enumerate(cs))
        parts.append(agg.selectExpr(f"stack({len(cs)}, {stack}) AS (check_name, violations)"))
    keyed = [c for c in checks if c.kind in ("unique", "relationships")]
    if keyed:
        parts.append(key_counts(tables, keyed))
    for name, (_, v, _) in custom.items():
        parts.append(v.selectExpr(f"'{name}' AS check_name", "count(1) AS violations"))
    # identical (check_name, violations) layout: positional union as a balanced
    # tree (a left-deep chain re-analyses the growing plan at every step)
    res = union_all(parts)
    meta = res.sparkSession.createDataFrame(
        [(c.name, c.table, c.kind, c.severity) for c in checks],
        "check_name string, table_name string, kind string, severity string")
    # Both sides have one row per check (a few dozen rows); a key check without keys has none.
    violations = F.coalesce("violations", F.lit(0)).cast("bigint")
    return (meta.join(F.broadcast(res), "check_name", "left").select(
        "check_name", "table_name", "kind", violations.alias("violations"),
        F.when(violations == 0, F.lit("pass"))
         .when(F.col("severity") == "warn", F.lit("warn"))
         .otherwise(F.lit("fail")).alias("status")))


def assert_suite(result: DataFrame) -> None:
    """Raise if any error-severity check failed (the build gate)."""
    failed = result.filter(F.col("status") == "fail").select("check_name", "violations").take(50)
    if failed:
        raise AssertionError(f"data-quality checks failed: {[tuple(r) for r in failed]}")


def _nn(table, *cols):
    return [Check(f"not_null_{table}_{c}", table, "not_null", c) for c in cols]


def _un(table, *cols):
    return [Check(f"unique_{table}_{c}", table, "unique", c) for c in cols]


def default_checks() -> list[Check]:
    """The pipeline's schema tests (sources, staging, marts), singular
    invariants and generator invariants."""
    return [
        # bronze sources
        *_nn("raw_transactions", "transaction_id", "card_id", "amount"),
        *_nn("raw_auth_events", "transaction_id"),
        *_nn("raw_chargebacks", "chargeback_id"), *_un("raw_chargebacks", "chargeback_id"),
        *_nn("raw_chargebacks", "transaction_id"),
        *_nn("raw_accounts", "account_id"), *_un("raw_accounts", "account_id"),
        *_nn("raw_cards", "card_id"), *_un("raw_cards", "card_id"),
        *_nn("raw_merchants", "merchant_id"), *_un("raw_merchants", "merchant_id"),
        # staging
        *_nn("stg_transactions", "transaction_id"), *_un("stg_transactions", "transaction_id"),
        *_nn("stg_transactions", "card_id"),
        Check("relationships_stg_transactions_card_id", "stg_transactions", "relationships", "card_id",
              to_table="stg_cards", to_column="card_id"),
        *_nn("stg_transactions", "amount_usd"),
        Check("accepted_range_stg_transactions_amount_usd", "stg_transactions", "accepted_range", "amount_usd",
              min_value=0, inclusive=False),
        Check("accepted_values_stg_transactions_entry_mode", "stg_transactions", "accepted_values", "entry_mode",
              values=ENTRY_MODES),
        *_nn("stg_auth_events", "transaction_id"), *_un("stg_auth_events", "transaction_id"),
        *_nn("stg_chargebacks", "chargeback_id"), *_un("stg_chargebacks", "chargeback_id"),
        *_nn("stg_chargebacks", "transaction_id"),
        Check("relationships_stg_chargebacks_transaction_id", "stg_chargebacks", "relationships", "transaction_id",
              to_table="stg_transactions", to_column="transaction_id"),
        *_nn("stg_cards", "card_id"), *_un("stg_cards", "card_id"),
        Check("relationships_stg_cards_account_id", "stg_cards", "relationships", "account_id",
              to_table="stg_accounts", to_column="account_id"),
        *_nn("stg_accounts", "account_id"), *_un("stg_accounts", "account_id"),
        *_nn("stg_merchants", "merchant_id"), *_un("stg_merchants", "merchant_id"),
        Check("accepted_range_stg_merchants_baseline_fraud_rate", "stg_merchants", "accepted_range",
              "baseline_fraud_rate", min_value=0, max_value=1),
        # marts
        *_nn("fct_transactions", "transaction_id"), *_un("fct_transactions", "transaction_id"),
        *_nn("fct_transactions", "amount_usd"),
        Check("accepted_range_fct_transactions_amount_usd", "fct_transactions", "accepted_range", "amount_usd",
              min_value=0, inclusive=False),
        Check("accepted_range_fct_transactions_geo_distance_from_home_km", "fct_transactions", "accepted_range",
              "geo_distance_from_home_km", min_value=0),
        Check("accepted_range_fct_transactions_geo_distance_from_prev_km", "fct_transactions", "accepted_range",
              "geo_distance_from_prev_km", min_value=0),
        *_nn("fct_transactions", "is_approved", "is_confirmed_fraud"),
        *_nn("dim_merchant", "merchant_id"), *_un("dim_merchant", "merchant_id"),
        Check("accepted_values_dim_merchant_risk_tier", "dim_merchant", "accepted_values", "risk_tier",
              values=RISK_TIERS),
        *_nn("dim_card", "card_id"), *_un("dim_card", "card_id"),
        Check("accepted_range_agg_fraud_by_hour_fraud_rate_pct", "agg_fraud_by_hour", "accepted_range",
              "fraud_rate_pct", min_value=0, max_value=100),
        *_nn("agg_merchant_risk", "merchant_id"), *_un("agg_merchant_risk", "merchant_id"),
        Check("accepted_range_mart_model_performance_precision", "mart_model_performance", "accepted_range",
              "precision", min_value=0, max_value=1),
        Check("accepted_range_mart_model_performance_recall", "mart_model_performance", "accepted_range",
              "recall", min_value=0, max_value=1),
        # singular invariants
        Check("assert_features_not_null", "fct_transactions", "expression", condition=" OR ".join(
            f"{c} IS NULL" for c in ["amount_log", "seconds_since_prev", "geo_distance_from_home_km",
                                     "geo_distance_from_prev_km", "is_new_device", "mcc_risk", "amount_zscore",
                                     "txn_count_60s", "txn_count_1h", "implied_speed_kmh"])),
        Check("assert_value_domains", "stg_transactions", "expression", condition=VALUE_DOMAIN_VIOLATION),
    ]
