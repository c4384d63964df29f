"""Append-only keyed tables: an upsert writes the rows of its batch and nothing else.

Layout: ``<root>/<date>=D/_label=L/*.parquet``.  Batch ``b`` is written under the
label ``2 * b`` into the date folders of its rows, with dynamic partition overwrite,
so writing a batch again replaces exactly its own files.  A reader resolves the newest
row of each key (the greatest label), whatever date it is filed under: a row whose
date has moved replaces the old one without its being looked up.

``compact`` rewrites the dates that have got new or outdated rows: after batch ``b``
such a date is one folder with the label ``2 * b + 1``, newer than all it holds and
older than the next batch.  When all of them are written, the label is noted under
``_marks``.  Up to the last noted label every key has one row and every date one live
folder; so a reader takes these without a shuffle, leaves out the keys that came
later, and resolves the later rows only.  A compaction that breaks off changes nothing
a reader sees: without its mark, its rows are simply rows with a newer label.

Folders that a compaction has replaced are removed by the next one (those of a date
that has lost all its rows at once), so a reader
that began before it still finds its files.  One writer appends at a time; a
compaction may run beside it.  A row with a NULL in its key is no other row's
successor: it stays, and a replayed batch replaces its own.

In a ``single`` table the writer gives each batch at most one row of a key, and may name
the keys that earlier batches hold (``_replaced/L``).  Its readers take all rows but
those that a later batch names, or has if it names none: no aggregate over whole rows,
no shuffle of them where few are replaced, and only the asked columns and dates.
"""
from __future__ import annotations

import re
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.expr import build_side
from ..operators.staging import dedup_latest
from . import files

LABEL = "_label"
REPLACED = "_replaced"


def overwrite_partitions(rows: DataFrame, path: str, *columns: str) -> None:
    """Replace the partitions that get rows.  Rows are dealt out by partition first;
    a partition with many rows is dealt to several tasks."""
    (rows.hint("rebalance", *columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*columns).parquet(path))


class KeyedTable:
    """``key``: the columns that identify a row.  ``date``: the partition column.
    ``many``: a batch may hold several rows of a key; all rows of the key's newest
    batch are current (state kept for each key; in a batch they share the partition),
    else one row is.  ``single``: no batch holds two rows of a key."""

    def __init__(self, spark: SparkSession, root: str, key: str | list[str], date: str = "event_date", many: bool = False, single: bool = False):
        self.spark, self.root, self.date, self.many, self.single = spark, root.rstrip("/"), date, many, single
        self.key = [key] if isinstance(key, str) else list(key)
        self._schema: StructType | None = None

    # ------------------------------------------------------------ files
    def schema(self) -> StructType | None:
        """The stored schema; read once, then as this writer has widened it."""
        if self._schema is None:
            self._schema = files.load_schema(self.spark, f"{self.root}/_schema")
        return self._schema

    def _save(self, schema: StructType) -> None:
        files.save_schema(self.spark, schema, f"{self.root}/_schema")
        self._schema = schema

    def create_if_absent(self, schema: StructType | str) -> None:
        """Declare the table: readers get no rows with these columns."""
        if self.schema() is None:
            self._save(files.schema_of(self.spark, schema))

    def exists(self) -> bool:
        return self.schema() is not None

    def _rows(self) -> DataFrame:
        """All rows with their labels."""
        kept = self.schema()
        if kept is None:
            raise FileNotFoundError(f"no table under {self.root}")
        whole = StructType([*kept.fields, StructField(LABEL, LongType())])
        return self.spark.read.schema(whole).parquet(self.root)

    def folders(self) -> list[tuple]:
        """(date, label) of each folder; read from partition values, no column is."""
        return [tuple(r) for r in self._rows().select(self.date, LABEL).distinct().collect()]

    def _mark(self, upto: int | None = None) -> int:
        """The label of the last complete compaction (of those up to a batch); -1 before the first."""
        marks = [int(name) for name in files.names(self.spark, f"{self.root}/_marks") if name.isdigit()]
        return max((m for m in marks if upto is None or m <= 2 * upto + 1), default=-1)

    def last_batch(self) -> int | None:
        """The greatest batch number written; None if there is none."""
        labels = [label for _, label in self.folders()] if self.exists() else []
        return max(labels) // 2 if labels else None

    # ------------------------------------------------------------ write
    def append(self, rows: DataFrame, batch: int, order: str | list[str] | None = None, replaces: DataFrame | None = None) -> None:
        """Upsert ``rows`` as ``batch`` (batches are numbered upwards from 0).  ``order``:
        of several rows of a key the greatest by it counts.  New columns widen the table.
        ``replaces`` (single tables): at least those keys of ``rows`` that earlier batches hold."""
        if order is not None and not self.many:
            rows = dedup_latest(rows, self.key, order)
        kept = self.schema()
        if kept is None:
            kept = StructType([StructField(f.name, f.dataType, True) for f in rows.schema.fields])
            self._save(kept)
        else:
            wide, added = files.merge_schemas(kept, rows.schema)
            if added:
                self._save(wide)
        if self.single:
            noted = f"{self.root}/{REPLACED}/{2 * int(batch)}"
            if replaces is not None:
                replaces.select(*self.key).write.mode("overwrite").parquet(noted)
            elif files.exists(self.spark, noted):
                files.remove(self.spark, noted)
        overwrite_partitions(rows.withColumn(LABEL, F.lit(2 * int(batch)).cast("long")), self.root, self.date, LABEL)

    # ------------------------------------------------------------ read
    def _labels(self, rows: DataFrame) -> set[int]:
        """The labels of the files that a scan has listed; no job is run."""
        return {int(found[1]) for found in map(re.compile(rf"/{LABEL}=(\d+)/").search, rows.inputFiles()) if found}

    def _noted(self) -> set[int]:
        """The labels whose batches have named the keys that they replace."""
        return {int(name) for name in files.names(self.spark, f"{self.root}/{REPLACED}") if name.isdigit()}

    def _replacing(self, rows: DataFrame, labels: set[int]) -> DataFrame:
        """(key, label) of those of ``rows`` with these labels that may replace earlier ones (single tables)."""
        noted = self._noted() & labels
        parts = [rows.where(F.col(LABEL).isin(labels - noted)).select(*self.key, LABEL)]
        keys = StructType([self.schema()[k] for k in self.key])
        parts += [self.spark.read.schema(keys).parquet(f"{self.root}/{REPLACED}/{label}").withColumn(LABEL, F.lit(label).cast("long")) for label in sorted(noted)]
        return reduce(DataFrame.unionByName, parts)

    def _newest(self, rows: DataFrame, labels: set[int]) -> DataFrame:
        """The current rows of each key among ``rows``, which have these labels."""
        if self.single:
            if len(labels) < 2:
                return rows
            last = max(labels)
            newer = [F.col(f"n.{k}") == F.col(f"r.{k}") for k in self.key] + [F.col(f"n.{LABEL}") > F.col(f"r.{LABEL}")]
            n = build_side(self._replacing(rows, labels - {min(labels)})).alias("n")
            old = rows.where(F.col(LABEL) < last).alias("r").join(n, reduce(lambda a, b: a & b, newer), "left_anti")
            return old.unionByName(rows.where(F.col(LABEL) == last))
        if not self.many:
            return dedup_latest(rows, self.key, LABEL)
        same = [F.col(f"n.{k}").eqNullSafe(F.col(f"r.{k}")) for k in self.key] + [F.col(f"n.{LABEL}") == F.col(f"r.{LABEL}")]
        last = rows.groupBy(*self.key).agg(F.max(LABEL).alias(LABEL))
        return rows.alias("r").join(last.alias("n"), reduce(lambda a, b: a & b, same), "left_semi")

    def _live(self, rows: DataFrame, folders: list[tuple], mark: int) -> DataFrame:
        """``rows`` up to the mark, without the folders that a compaction has replaced."""
        top = {}
        for d, label in folders:
            if label <= mark:
                top[d] = max(label, top.get(d, -1))
        old = [self._is(d, label) for d, label in folders if label <= mark and label < top[d]]
        base = rows.where(F.col(LABEL) <= mark)
        return base.where(~reduce(lambda a, b: a | b, old)) if old else base

    def _is(self, date, label: int) -> Column:
        return F.col(self.date).eqNullSafe(F.lit(date)) & (F.col(LABEL) == label)

    def read(self, upto: int | None = None) -> DataFrame:
        """The newest rows of all keys; ``upto``: as of that batch, if no later one has
        been compacted.  A filter on the date column reaches the partitions of all
        compacted rows."""
        return self._current(upto).drop(LABEL)

    def _current(self, upto: int | None = None) -> DataFrame:
        rows, mark = self._rows(), self._mark(upto)
        labels = self._labels(rows) if self.single else set()
        if upto is not None:
            rows = rows.where(F.col(LABEL) <= 2 * upto + 1)
            labels = {label for label in labels if label <= 2 * upto + 1}
        if mark < 0:
            return self._newest(rows, labels)
        later = rows.where(F.col(LABEL) > mark)
        return self._merged(rows, self._live(rows, self.folders(), mark), later, {label for label in labels if label > mark})

    def _merged(self, rows: DataFrame, base: DataFrame, later: DataFrame, labels: set[int]) -> DataFrame:
        """The compacted rows that no later one replaces, and the newest of those."""
        keys = build_side(self._replacing(later, labels).select(*self.key)) if self.single else later.select(*self.key)
        return base.join(keys, self.key, "left_anti").select(*rows.columns).unionByName(self._newest(later, labels).select(*rows.columns))

    def since(self, batch: int) -> DataFrame:
        """The rows that were written by ``batch`` and later ones."""
        return self._rows().where(F.col(LABEL) >= 2 * batch).drop(LABEL)

    def discard(self, batch: int) -> None:
        """Remove what an attempt at ``batch`` has written, before another one."""
        if self.exists():
            self._remove([(d, label) for d, label in self.folders() if label >= 2 * batch])
            self._forget_noted(lambda label: label >= 2 * batch)

    def drop_before(self, batch: int) -> None:
        """Remove batches below ``batch`` (snapshots that nobody reads any more)."""
        self._remove([(d, label) for d, label in self.folders() if label < 2 * batch])

    def forget(self, dates: list) -> None:
        """Remove dates whole (derived rows of dates that have no source rows any more)."""
        self._remove([(d, label) for d, label in self.folders() if d in dates])

    # ------------------------------------------------------------ compact
    def compact(self) -> list:
        """Rewrite the dates with rows after the last compaction, or with rows that
        those replace; returns these dates."""
        if not self.exists():
            return []
        folders, mark = self.folders(), self._mark()
        upto = max((label for _, label in folders if label % 2 == 0 and label > mark), default=None)
        if upto is None:
            return []
        rows = self._rows().where(F.col(LABEL) <= upto)
        base, later = self._live(rows, folders, mark), rows.where(F.col(LABEL) > mark)
        dates = {d for d, label in folders if mark < label <= upto}
        labels = {label for _, label in folders if mark < label <= upto}
        if mark >= 0:
            self._forget_noted(lambda label: label <= mark)
            keys = build_side(self._replacing(later, labels).select(*self.key)) if self.single else later.select(*self.key)
            dates |= {r[0] for r in base.join(keys, self.key, "left_semi").select(self.date).distinct().collect()}
            now = self._merged(rows, base, later, labels)
        else:
            now = self._newest(rows, labels)
        touched = reduce(lambda a, b: a | b, [F.col(self.date).eqNullSafe(F.lit(d)) for d in sorted(dates, key=str)])
        overwrite_partitions(now.where(touched).withColumn(LABEL, F.lit(upto + 1).cast("long")), self.root, self.date, LABEL)
        left = {d for d, label in self.folders() if label == upto + 1}
        replaced = [(d, label) for d, label in folders if label <= mark and any(label < x <= mark for e, x in folders if e == d)]
        # a date all of whose rows have moved away has no new folder: its old one goes now, before the mark
        self._remove(replaced + [(d, label) for d, label in folders if d in dates - left and label <= upto])
        files.touch(self.spark, f"{self.root}/_marks/{upto + 1}")
        return sorted(dates, key=str)

    def _forget_noted(self, which) -> None:
        """Remove the lists of replaced keys of some labels."""
        for label in self._noted() if self.single else ():
            if which(label):
                files.remove(self.spark, f"{self.root}/{REPLACED}/{label}")

    def _remove(self, folders: list[tuple]) -> None:
        for d, label in folders:
            name = files.HIVE_NULL if d is None else quote(str(d), safe=" -_.")
            files.remove(self.spark, f"{self.root}/{self.date}={name}/{LABEL}={label}")
