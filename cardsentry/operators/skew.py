"""Exact window evaluation for hot keys.

A window partitioned by a key runs each key's rows in one task.  When one key
holds a large share of all rows (a card, a merchant, or all rows without one) that
task becomes the whole job.  Its two kinds of frames are split in two ways.

*Row frames* (the previous row, the last 50 rows): hot rows are sorted by range over
key and order, which deals them out evenly however the key's rows lie in time, and
stored; a row's number is its place in its range plus the totals of the ranges before
(prefix sums over ranges, not rows).  Slices of equal row counts follow from the number,
and each takes the last rows before it as read-only context.  How many ranges there are
follows from the rows and the cores, not from the length of a slice.

*Range frames* that count rows of the last seconds: rows are counted by (key, second)
first, with map-side combine, so a window sees one row for each second, whatever
happened in it.  Seconds are met in slices of time with the seconds before as
context, and the counts go back to the rows by a join on key and second.

Hot keys are found with a grouped count (map-side combined, so the hot key
itself does not skew it) and stored; the hot set has at most ``rows / threshold``
entries, and is broadcast below a checked bound.
"""
from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.expr import broadcast_if_small
from ..session import scratch_path

SLICE = "_slice"
CTX = "_ctx"
#: Seconds that a slice of (key, second) counts spans: one row a second at most.
SLICE_SECONDS = 86_400
#: Rows that a range may hold when there are more than a few for each core.
RANGE_ROWS = 500_000


@dataclass(frozen=True)
class SliceSpec:
    key: str                 # partition key of the windows
    epoch: str               # whole-second event time (bigint)
    order: tuple[str, ...]   # total order used by row frames (starts with epoch)
    rows_back: int           # widest ROWS frame / lag offset looking back
    secs_back: int           # widest RANGE frame looking back, in seconds


def hot_keys(df: DataFrame, spec: SliceSpec, threshold: int) -> DataFrame | None:
    """Keys (NULL among them) with more than ``threshold`` rows; None if no key is hot.
    A table of no more rows than that needs no look at its keys.  Counted once: every
    use of the keys reads them from the shared folder."""
    if df.count() <= threshold:
        return None
    stats = df.groupBy(spec.key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > threshold)
    hot = stored(stats.select(spec.key), "hot")
    return None if hot.isEmpty() else hot


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back."""
    path = scratch_path(rows.sparkSession, f"{name}-{uuid.uuid4().hex}")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _is(left: str, right: str, *columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def split_hot(df: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cold rows, hot rows).  ``hot`` is broadcast if it is small; a large one has
    keys of few rows each, for the planner to join as it likes."""
    a, b = df.alias("a"), broadcast_if_small(hot).alias("b")
    return a.join(b, _is("a", "b", key), "left_anti"), a.join(b, _is("a", "b", key), "left_semi")


def dealt_by_range(rows: DataFrame, order: list, ranges: int) -> DataFrame:
    """The rows in ``ranges`` ranges of about equal size in ``order``, with ``_range`` and
    the row's ``_place`` in it.  Written to the shared folder, so ranges and places hold
    for every later use, whichever executor is lost."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = (rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
             .withColumn("_range", F.spark_partition_id()).withColumn("_place", place))
    return stored(dealt, "ranges")


def dealt_rows(rows: DataFrame, spec: SliceSpec, slice_rows: int) -> DataFrame:
    """:func:`dealt_by_range` over key and order: no range below a slice, and else as many as
    the cores share well or as hold ``RANGE_ROWS`` rows each."""
    spark, n = rows.sparkSession, rows.count()
    enough = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return dealt_by_range(rows, [spec.key, *spec.order], max(1, min(-(-n // slice_rows), max(enough, -(-n // RANGE_ROWS)))))


def equal_slices(rows: DataFrame, spec: SliceSpec, slice_rows: int) -> DataFrame:
    """The rows with ``_slice``, of ``slice_rows`` consecutive rows in order of key and
    ``spec.order``, and the ``rows_back`` rows before each slice once more as its context
    (``_ctx`` true).  A key's rows in a slice are those with both: slices don't end at keys."""
    return slices_of(dealt_rows(rows, spec, slice_rows), spec, slice_rows)


def slices_of(dealt: DataFrame, spec: SliceSpec, slice_rows: int) -> DataFrame:
    """:func:`equal_slices` of rows that are dealt out already."""
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range
    starts = (dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
              .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    out = dealt.join(F.broadcast(starts), "_range").withColumn("_number", F.col("_start") + F.col("_place"))
    own = F.floor(F.col("_number") / slice_rows).cast("bigint")
    reached = F.floor((F.col("_number") + spec.rows_back) / slice_rows).cast("bigint")
    return (out.withColumn("_own", own).withColumn(SLICE, F.explode(F.sequence("_own", reached)))
            .withColumn(CTX, F.col(SLICE) != F.col("_own")).drop("_own", "_number", "_range", "_place", "_start"))


def drop_context(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(CTX)).drop(CTX, SLICE)


def trailing_counts(rows: DataFrame, key: str, epoch: str, windows: dict[str, int], slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """(key, epoch, one column for each of ``windows``): how many rows the key has in the
    last so many seconds, the second itself included, for each second with a row."""
    back = max(windows.values())
    width = max(slice_seconds, back)
    seconds = rows.groupBy(key, epoch).agg(F.count(F.lit(1)).alias("_n"))
    own = F.floor(F.col(epoch) / width).cast("bigint")
    reached = F.floor((F.col(epoch) + back) / width).cast("bigint")
    # rows without time are peers of each other and of no one else
    met = F.when(F.col(epoch).isNull(), F.array(F.lit(None).cast("bigint"))).otherwise(F.sequence(own, reached))
    sliced = seconds.withColumn("_own", own).withColumn(SLICE, F.explode(met))
    order = Window.partitionBy(key, SLICE).orderBy(epoch)
    counted = sliced.select(key, epoch, "_own", SLICE, *[F.sum("_n").over(order.rangeBetween(-s, 0)).alias(c) for c, s in windows.items()])
    return counted.where(F.col(SLICE).eqNullSafe(F.col("_own"))).drop("_own", SLICE)


def with_counts(rows: DataFrame, counts: DataFrame, key: str, epoch: str) -> DataFrame:
    """The rows with the counts of their key and second (an inner join: counts may have been filtered)."""
    names = [c for c in counts.columns if c not in (key, epoch)]
    return rows.alias("r").join(counts.alias("c"), _is("r", "c", key, epoch)).select("r.*", *[f"c.{c}" for c in names])


def top_k_per_key(df: DataFrame, key: str, order_desc: list[str], k: int, salts: int = 16,
                  salt_col: str = "transaction_id") -> DataFrame:
    """The ``k`` greatest rows per key by ``order_desc``, exactly, without
    putting a hot key into one task: rows are first ranked within
    (key, salt) groups, each keeping its top ``k`` (the overall top ``k`` is
    contained in their union), then the at most ``k * salts`` survivors per
    key are ranked again."""
    order = [F.col(c).desc() for c in order_desc]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_col), F.lit(salts)))
    first = (salted.withColumn("_r", F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order)))
             .filter(F.col("_r") <= k).drop("_r", "_salt"))
    return (first.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
            .filter(F.col("_r") <= k).drop("_r"))
