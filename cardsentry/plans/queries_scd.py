"""SCD2 card history, current dimension and as-of join."""
from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..operators import scd2
from ..sources import testdata
from .catalog import register
from .context import Pipeline, ntz
from .oracle import q

_COLS = "card_id, account_id, card_type, primary_device_id, home_country, is_active"
_CHANGED = ("NOT (c.is_active IS NOT DISTINCT FROM s.is_active AND c.card_type IS NOT DISTINCT FROM s.card_type"
            " AND c.home_country IS NOT DISTINCT FROM s.home_country)")


def _step(out: str, h: str, snap: str, t: str) -> str:
    return f"""
, {out} AS (
  SELECT * FROM {h} WHERE valid_to IS NOT NULL
  UNION ALL
  SELECT c.card_id, c.account_id, c.card_type, c.primary_device_id, c.home_country, c.is_active, c.valid_from,
         CASE WHEN s.card_id IS NULL OR {_CHANGED} THEN TIMESTAMP '{t}' ELSE c.valid_to END AS valid_to
  FROM (SELECT * FROM {h} WHERE valid_to IS NULL) c LEFT JOIN {snap} s ON c.card_id = s.card_id
  UNION ALL
  SELECT s.card_id, s.account_id, s.card_type, s.primary_device_id, s.home_country, s.is_active,
         TIMESTAMP '{t}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
  FROM {snap} s LEFT JOIN (SELECT * FROM {h} WHERE valid_to IS NULL) c ON c.card_id = s.card_id
  WHERE c.card_id IS NULL OR {_CHANGED})"""


SCD_CTES = f"""
, s1 AS (SELECT {_COLS} FROM raw_cards)
, s2 AS (SELECT card_id, account_id,
                CASE WHEN card_id % 13 = 0 THEN CASE WHEN card_type = 'credit' THEN 'debit' ELSE 'credit' END
                     ELSE card_type END AS card_type,
                CASE WHEN card_id % 17 = 0 THEN 'N' || CAST(card_id AS VARCHAR) ELSE primary_device_id END AS primary_device_id,
                home_country,
                CASE WHEN card_id % 7 = 0 THEN NOT is_active ELSE is_active END AS is_active
         FROM raw_cards WHERE card_id % 11 <> 0)
, h1 AS (SELECT {_COLS}, TIMESTAMP '{testdata.SNAPSHOT_1}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM s1)
{_step('h2', 'h1', 's2', testdata.SNAPSHOT_2)}
{_step('h3', 'h2', 's1', testdata.SNAPSHOT_3)}
"""


def _p(spark, sf_dir):
    return Pipeline.get(spark, sf_dir)


@register("scd_01_change_detection", q(SCD_CTES + f"""
SELECT coalesce(c.card_id, s.card_id) AS card_id,
       CASE WHEN c.card_id IS NOT NULL AND s.card_id IS NOT NULL THEN 'changed'
            WHEN s.card_id IS NULL THEN 'deleted' ELSE 'new' END AS change
FROM s1 c FULL OUTER JOIN s2 s ON c.card_id = s.card_id
WHERE c.card_id IS NULL OR s.card_id IS NULL OR {_CHANGED}"""))
def scd_01(spark, sf_dir):
    s1 = testdata.card_snapshot(spark, sf_dir, 1)
    s2 = testdata.card_snapshot(spark, sf_dir, 2)
    return scd2.change_set(s1, s2, "card_id", testdata.CARD_CHECK_COLS)


@register("scd_02_history_two_snapshots", q(SCD_CTES + "SELECT * FROM h2"))
def scd_02(spark, sf_dir):
    return ntz(_p(spark, sf_dir).card_history(2))


@register("scd_03_hard_delete_closures", q(SCD_CTES + f"""
SELECT h.* FROM h2 h WHERE h.valid_to = TIMESTAMP '{testdata.SNAPSHOT_2}'
  AND NOT EXISTS (SELECT 1 FROM s2 WHERE s2.card_id = h.card_id)"""))
def scd_03(spark, sf_dir):
    h = _p(spark, sf_dir).card_history(2)
    s2 = testdata.card_snapshot(spark, sf_dir, 2).select("card_id")
    closed = h.filter(F.col("valid_to") == F.lit(testdata.SNAPSHOT_2).cast("timestamp"))
    return ntz(closed.join(s2, "card_id", "left_anti"))


@register("scd_04_reappearing_keys", q(SCD_CTES + f"""
SELECT * FROM h3 WHERE valid_from = TIMESTAMP '{testdata.SNAPSHOT_3}'"""))
def scd_04(spark, sf_dir):
    h = _p(spark, sf_dir).card_history(3)
    return ntz(h.filter(F.col("valid_from") == F.lit(testdata.SNAPSHOT_3).cast("timestamp")))


@register("scd_05_current_view", q(SCD_CTES + "SELECT * FROM h2 WHERE valid_to IS NULL"))
def scd_05(spark, sf_dir):
    return ntz(scd2.current_view(_p(spark, sf_dir).card_history(2)))


@register("scd_06_history_three_snapshots", q(SCD_CTES + "SELECT * FROM h3"))
def scd_06(spark, sf_dir):
    return ntz(_p(spark, sf_dir).card_history(3))


DIM_CARD_SQL = SCD_CTES + """
, dim_card AS (
  SELECT c.card_id, c.account_id, c.card_type, c.home_country, c.is_active,
         a.risk_band AS account_risk_band, a.signup_date AS account_signup_date
  FROM h2 c LEFT JOIN stg_accounts a ON c.account_id = a.account_id WHERE c.valid_to IS NULL)
"""


@register("prj_09_dim_card", q(DIM_CARD_SQL + "SELECT * FROM dim_card"))
def prj_09(spark, sf_dir):
    return _p(spark, sf_dir).dim_card


@register("join_13_asof_card_state", q(SCD_CTES + """
SELECT t.transaction_id, t.card_id, h.is_active, h.card_type, h.valid_from
FROM stg_transactions t LEFT JOIN h2 h
  ON t.card_id = h.card_id AND t.event_ts >= h.valid_from AND (h.valid_to IS NULL OR t.event_ts < h.valid_to)"""))
def join_13(spark, sf_dir):
    p = _p(spark, sf_dir)
    t = p.silver["transactions"].select("transaction_id", "card_id", "event_ts")
    j = scd2.as_of_join(t, p.card_history(2), "card_id", "event_ts", ["is_active", "card_type"])
    return ntz(j.select("transaction_id", "card_id", "is_active", "card_type", "valid_from"))


_MANY = """
, busy AS (SELECT transaction_id, card_id % 3 AS k, event_ts FROM stg_transactions)
, starts AS (SELECT k, event_ts AS valid_from, min(transaction_id) AS version FROM busy WHERE transaction_id % 2 = 0 GROUP BY k, event_ts)
, versions AS (SELECT *, least(lead(valid_from) OVER (PARTITION BY k ORDER BY valid_from), valid_from + INTERVAL 10 MINUTE) AS valid_to FROM starts)
SELECT b.transaction_id, b.k, v.version, v.valid_from FROM busy b
LEFT JOIN versions v ON v.k = b.k AND b.event_ts >= v.valid_from AND b.event_ts < v.valid_to"""


@register("join_13b_asof_many_versions", q(_MANY))
def join_13b(spark, sf_dir):
    """Three keys with a version at every other transaction, with gaps between them;
    each key's facts are merged in slices of 500."""
    t = _p(spark, sf_dir).silver["transactions"].select("transaction_id", (F.col("card_id") % 3).alias("k"), "event_ts")
    starts = t.where("transaction_id % 2 = 0").groupBy("k", F.col("event_ts").alias("valid_from")).agg(F.min("transaction_id").alias("version"))
    after = F.lead("valid_from").over(Window.partitionBy("k").orderBy("valid_from"))
    versions = starts.withColumn("valid_to", F.least(after, F.col("valid_from") + F.expr("INTERVAL 10 MINUTES")))
    return ntz(scd2.as_of_join(t, versions, "k", "event_ts", ["version"], hot_rows=500).select("transaction_id", "k", "version", "valid_from"))
