"""Contiguous shards of near-equal bytes from global prefix sums.

Rows are sorted by range on the document id; each range is one partition of a
written table.  The ranges' totals (one row each) give every range the bytes and
rows before it, so a row's global byte offset is its range's start plus a running
sum inside the range, and no task sees more than one range.  Cuts lie at equal
targets of the total: a row goes to the shard in which its middle byte falls.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import prepare, stored

ROW_BYTES = 16
RANGE_ROWS = 100_000


def byte_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): size (UTF-8 bytes, 16 more),
    text_crc32 (null text: of no bytes), law, shard, slot, grown_shard, start.

    Shards are contiguous in (doc_id, text hash) order, null ids first; a shard's
    bytes differ from the equal share by one document's size at most.  Rows that
    repeat keep a slot each.  An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    # ids may be lost in a hot value, so the order goes on to the text and to where the row was read
    ranges = max(1, -(-docs.count() // RANGE_ROWS), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["doc_id", "tie", "row"]
    sorted_ = stored(rows.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()), "ranges")
    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = sorted_.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))  # one row for each range
    starts = totals.select("part", F.coalesce(F.sum("bytes").over(by_part), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("n").over(by_part), F.lit(0)).alias("rows_before"))
    total = sorted_.agg(F.sum("size")).first()[0] or 0
    inside = Window.partitionBy("part").orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = sorted_.join(starts, "part").select("*", (F.col("bytes_before") + F.coalesce(F.sum("size").over(so_far), F.lit(0))).alias("start"),
                                                 (F.col("rows_before") + F.row_number().over(inside) - 1).cast("long").alias("rank"))
    shard = F.least(F.lit(shards - 1), F.expr(f"cast((cast(2 * start + size as decimal(38,0)) * {shards}) div {2 * max(total, 1)} as int)"))
    placed = stored(placed.withColumn("shard", shard), "placed")
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))  # a row for each shard
    return placed.join(first, "shard").select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rank") - F.col("first")).alias("slot"),
                                              F.lit(None).cast("int").alias("grown_shard"), "start")
