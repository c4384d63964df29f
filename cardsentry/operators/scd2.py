"""Slowly changing dimension, type 2 (check strategy).

History rows carry ``valid_from`` / ``valid_to`` (NULL = current version).
Applying a snapshot is one full outer join of the *current* versions with the
snapshot on the key (both sides have unique keys, so no key is hot), unioned
with the already closed versions that pass through untouched.
"""
from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.expr import broadcast_if_small
from . import skew

VALID_FROM, VALID_TO = "valid_from", "valid_to"
#: Facts of a key above which they are merged with its versions in slices.
HOT_ROWS = 2_000_000


def _ts(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def changed(check_cols: list[str], left: str = "c", right: str = "s") -> Column:
    """Null-safe "any checked column differs"."""
    same = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in check_cols]
    return ~reduce(lambda a, b: a & b, same)


def scd2_init(snapshot: DataFrame, as_of) -> DataFrame:
    return snapshot.select("*", _ts(as_of).alias(VALID_FROM), F.lit(None).cast("timestamp").alias(VALID_TO))


def scd2_apply(history: DataFrame | None, snapshot: DataFrame, key: str, check_cols: list[str],
               as_of, invalidate_hard_deletes: bool = True) -> DataFrame:
    """New history after observing ``snapshot`` at ``as_of``.

    * key in both, a checked column differs  -> close current, open new version
    * key in both, no checked column differs -> keep current as is (other
      columns are not refreshed, as in the check strategy)
    * key only in history                    -> close (hard delete) if requested
    * key only in snapshot (new/reappearing) -> open a version
    """
    if history is None:
        return scd2_init(snapshot, as_of)
    cols = snapshot.columns
    t = _ts(as_of)
    closed = history.filter(F.col(VALID_TO).isNotNull())
    cur = history.filter(F.col(VALID_TO).isNull()).alias("c")
    snap = snapshot.alias("s")
    j = cur.join(snap, F.col(f"c.{key}") == F.col(f"s.{key}"), "full_outer")
    in_c, in_s = F.col(f"c.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    diff = changed(check_cols)
    close_now = in_c & ((in_s & diff) | (~in_s if invalidate_hard_deletes else F.lit(False)))
    kept = j.filter(in_c).select(
        *[F.col(f"c.{c}").alias(c) for c in cols],
        F.col(f"c.{VALID_FROM}").alias(VALID_FROM),
        F.when(close_now, t).otherwise(F.col(f"c.{VALID_TO}")).alias(VALID_TO))
    opened = j.filter(in_s & (~in_c | diff)).select(
        *[F.col(f"s.{c}").alias(c) for c in cols],
        t.alias(VALID_FROM), F.lit(None).cast("timestamp").alias(VALID_TO))
    return closed.unionByName(kept).unionByName(opened)


def change_set(current: DataFrame, snapshot: DataFrame, key: str, check_cols: list[str]) -> DataFrame:
    """Keys whose state changes: 'changed', 'deleted' or 'new'."""
    j = current.alias("c").join(snapshot.alias("s"), F.col(f"c.{key}") == F.col(f"s.{key}"), "full_outer")
    in_c, in_s = F.col(f"c.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    kind = (F.when(in_c & in_s & changed(check_cols), F.lit("changed"))
            .when(in_c & ~in_s, F.lit("deleted"))
            .when(~in_c & in_s, F.lit("new")))
    return j.select(F.coalesce(F.col(f"c.{key}"), F.col(f"s.{key}")).alias(key), kind.alias("change")) \
            .filter(F.col("change").isNotNull())


def current_view(history: DataFrame) -> DataFrame:
    return history.filter(F.col(VALID_TO).isNull())


def as_of_join(facts: DataFrame, history: DataFrame, key: str, ts_col: str,
               cols: list[str], how: str = "left", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Attach the version of ``history`` valid at each fact's ``ts_col``.

    Facts and versions are merged in order of (key, time) and each fact takes the last
    version before it, if that is still valid: the cost is that of sorting facts and
    versions once, however many versions a key has.  Keys (or none) with more than
    ``hot_rows`` facts are merged in slices of as many rows, facts and versions counted;
    a slice starts with the last version before it.  Facts without key or time have no version.
    """
    versions = history.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.struct(VALID_FROM, VALID_TO, *cols).alias("_version"))
    spec = skew.SliceSpec(key, ts_col, (ts_col,), 0, 0)
    hot = skew.hot_keys(facts, spec, hot_rows) if hot_rows else None
    if hot is None:
        return _merged(_in_one(facts, facts.columns, versions, key, ts_col), ["_p"], F.lit(None), cols, how)
    cold, busy = skew.split_hot(facts, key, hot)
    busy_versions = versions.where(f"_version.{VALID_FROM} is not null").join(broadcast_if_small(hot.withColumnRenamed(key, "_k")), "_k", "left_semi")
    rows = _in_one(busy, facts.columns, busy_versions, key, ts_col)
    sliced = skew.equal_slices(rows, skew.SliceSpec("_p", "_t", ("_t", "_kind"), 0, 0), hot_rows).drop(skew.CTX)
    # one row for each slice and key: rows / hot_rows, and one more for each hot key
    ends = sliced.groupBy("_p", skew.SLICE).agg(F.max_by("_version", F.when(F.col("_kind") == 0, F.col("_t"))).alias("_end"))
    before = Window.partitionBy("_p").orderBy(skew.SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).drop("_end")
    begun = sliced.alias("r").join(carried.alias("c"), F.col("r._p").eqNullSafe(F.col("c._p")) & (F.col(f"r.{skew.SLICE}") == F.col(f"c.{skew.SLICE}"))).select("r.*", "c._carried")
    return _merged(_in_one(cold, facts.columns, versions, key, ts_col), ["_p"], F.lit(None), cols, how).unionByName(
        _merged(begun, ["_p", skew.SLICE], F.col("_carried"), cols, how))


def _in_one(facts: DataFrame, names: list[str], versions: DataFrame, key: str, ts_col: str) -> DataFrame:
    """Facts and versions as rows of one table, with key ``_p`` and time ``_t``; a version comes before a fact of the same time."""
    rows = facts.select(F.col(key).alias("_p"), F.col(ts_col).alias("_t"), F.lit(1).alias("_kind"),
                        F.struct(*names).alias("_fact"), F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"))
    marks = versions.select(F.col("_k").alias("_p"), F.col(f"_version.{VALID_FROM}").alias("_t"), F.lit(0).alias("_kind"),
                            F.lit(None).cast(rows.schema["_fact"].dataType).alias("_fact"), "_version")
    return rows.unionByName(marks)


def _merged(rows: DataFrame, parts: list[str], carried: Column, cols: list[str], how: str) -> DataFrame:
    """``as_of_join`` within the groups of ``parts``; ``carried``: the last version before a group."""
    order = Window.partitionBy(*parts).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_last", F.coalesce(F.last("_version", ignorenulls=True).over(order), carried)).where("_kind = 1")
    valid = F.col("_last").isNotNull() & F.col("_t").isNotNull() & (F.col(f"_last.{VALID_TO}").isNull() | (F.col("_t") < F.col(f"_last.{VALID_TO}")))
    if how == "inner":
        found = found.where(valid)
    return found.select("_fact.*", *[F.when(valid, F.col(f"_last.{c}")).alias(c) for c in (*cols, VALID_FROM, VALID_TO)])


class SCD2Table:
    """Persisted SCD2 history whose apply cost follows the keys, not the history.

    * ``current``: the open versions, a ``VersionedTable`` rewritten per apply
      (one row per key), versioned by the apply time in epoch seconds;
    * ``closed``: closed versions, one Parquet partition per apply time, written
      with dynamic partition overwrite.

    Re-running an apply for the same ``as_of`` starts from the current version
    before it and overwrites its own closed partition, so replays are
    idempotent.  The full history is ``closed ∪ current``.
    """

    def __init__(self, spark, root: str):
        from ..sources.tables import VersionedTable
        self.spark, self.root = spark, root.rstrip("/")
        self.current = VersionedTable(spark, f"{self.root}/current")

    def _version(self, as_of) -> int:
        return int(self.spark.range(1).select(F.unix_timestamp(_ts(as_of))).first()[0])

    def apply(self, snapshot: DataFrame, key: str, check_cols: list[str], as_of,
              invalidate_hard_deletes: bool = True) -> None:
        v = self._version(as_of)
        base = self.current.latest_before(v)
        cur = self.current.read(base) if base is not None else None
        step = scd2_apply(cur, snapshot, key, check_cols, as_of, invalidate_hard_deletes)
        closed = step.filter(F.col(VALID_TO).isNotNull()).withColumn("_closed_at", F.lit(v).cast("bigint"))
        prev_mode = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            closed.write.mode("overwrite").partitionBy("_closed_at").parquet(f"{self.root}/closed")
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev_mode)
        self.current.write(step.filter(F.col(VALID_TO).isNull()), version=v, note=str(as_of))

    def history(self) -> DataFrame:
        cur = self.current.read()
        v = self.current.current_version()
        try:
            closed = (self.spark.read.parquet(f"{self.root}/closed")
                      .filter(F.col("_closed_at") <= v).drop("_closed_at"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return cur  # nothing closed yet
        return closed.unionByName(cur)
