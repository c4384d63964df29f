"""Versioned Parquet tables with a keyed upsert.

There is no transaction log here, only plain Parquet directories:

* ``VersionedTable``: every write goes to a new ``v=<n>`` directory; a version
  becomes current when a one-line record is appended to ``_commits`` (a JSON
  table), so readers never see a half-written version and a job never
  overwrites what its own plan is reading.  Writing version ``n`` again (a
  replayed micro-batch) rewrites that directory and is idempotent.
* ``upsert_partitions``: for large date-partitioned tables, only the
  partitions touched by the updates are rewritten (dynamic partition
  overwrite), after the merged rows were staged under the shared checkpoint
  folder, so the cost follows the updates, not the table.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from ..operators.incremental import merge_by_key
from ..session import scratch_path

COMMITS = "_commits"


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema("version long, rows long, note string").json(f"{self.root}/{COMMITS}")
        except AnalysisException:
            return None

    def current_version(self) -> int | None:
        c = self._commits()
        if c is None:
            return None
        v = c.agg(F.max("version")).first()[0]
        return None if v is None else int(v)

    def latest_before(self, version: int) -> int | None:
        """Latest committed version strictly below ``version``."""
        c = self._commits()
        if c is None:
            return None
        v = c.filter(F.col("version") < version).agg(F.max("version")).first()[0]
        return None if v is None else int(v)

    def exists(self) -> bool:
        return self.current_version() is not None

    def read(self, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        return self.spark.read.parquet(f"{self.root}/v={v}")

    def write(self, df: DataFrame, version: int | None = None, partition_by: list[str] | None = None,
              note: str = "") -> int:
        cur = self.current_version()
        v = (0 if cur is None else cur + 1) if version is None else version
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.root}/v={v}")
        rows = self.spark.read.parquet(f"{self.root}/v={v}").count()
        self.spark.createDataFrame([(v, rows, note)], "version long, rows long, note string") \
            .coalesce(1).write.mode("append").json(f"{self.root}/{COMMITS}")
        return v

    def create_if_absent(self, schema: StructType | str) -> None:
        """Declared serving table: an empty committed version with ``schema``."""
        if not self.exists():
            self.write(self.spark.createDataFrame([], schema), note="create")

    def upsert(self, updates: DataFrame, key: str | list[str], version: int | None = None,
               dedup_order: str | list[str] | None = None, partition_by: list[str] | None = None) -> int:
        """Merge ``updates`` on ``key`` into the current version and commit the
        result as a new version (or as ``version``, for replayable batches:
        the merge then starts from the version before it)."""
        base_v = self.latest_before(version) if version is not None else self.current_version()
        if base_v is None:
            merged = updates if dedup_order is None else merge_by_key(updates.limit(0), updates, key, dedup_order)
        else:
            merged = merge_by_key(self.read(base_v), updates, key, dedup_order)
        return self.write(merged, version=version, partition_by=partition_by)


def upsert_partitions(spark: SparkSession, path: str, updates: DataFrame, key: str,
                      partition_col: str = "event_date") -> None:
    """Rewrite only the partitions of ``path`` that ``updates`` touch."""
    try:
        target = spark.read.parquet(path)
    except AnalysisException:
        target = None
    if target is None:
        updates.write.mode("overwrite").partitionBy(partition_col).parquet(path)
        return
    touched = updates.select(partition_col).distinct()
    old = target.join(touched, partition_col, "left_semi")
    merged = merge_by_key(old, updates, key)
    stage = scratch_path(spark, f"upsert-{uuid.uuid4().hex}")
    merged.write.mode("overwrite").partitionBy(partition_col).parquet(stage)
    staged = spark.read.parquet(stage)
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        staged.write.mode("overwrite").partitionBy(partition_col).parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def materialize(df: DataFrame, kind: str, name: str, path: str | None = None) -> DataFrame:
    """Per-layer materialisation: ``ephemeral`` (inline plan), ``view``
    (session temp view), ``table`` (Parquet written once, read back so later
    plans start from the files)."""
    if kind == "ephemeral":
        return df
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if kind == "table":
        target = path or scratch_path(df.sparkSession, name)
        df.write.mode("overwrite").parquet(target)
        return df.sparkSession.read.parquet(target)
    raise ValueError(f"unknown materialisation {kind}")
