"""Which days of which cards an arrival touches.

A row's features look back over its card's last ``AMOUNT_ROWS`` rows and over the
widest velocity window.  So a row that arrives, changes or leaves at some place of its
card's history changes the rows behind it until that many rows lie between, or that
many seconds: the *dirty* rows.  To recompute them, the rows before the first of them
are needed in turn: its *context*.

Both are found from a small table of row counts by card and day, ``(card_id, day,
event_date, n)``, without reading a transaction.  ``day`` is the day of the row's time
(its place in the card's order; null, for a row without time, comes first), and
``event_date`` the folder it is filed under.  Whole days are taken, which may recompute
a few rows more than have changed, to the same values.  The counts are read back only
as far as some touched card still lacks ``AMOUNT_ROWS`` rows of context.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.expr import build_side
from .features import AMOUNT_ROWS, VELOCITY_SECONDS

DAY_SECONDS = 86_400
#: Days of counts that are read at first before the earliest change; then four times as many.
LOOK_BACK_DAYS = 32


def positions(txn: DataFrame) -> DataFrame:
    """(card_id, day, event_date, epoch) of staged transactions."""
    return txn.select("card_id", F.to_date("event_ts").alias("day"), "event_date", F.unix_timestamp("event_ts").alias("epoch"))


def count_changes(added: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """Changes (card_id, day, event_date, n) of the row counts by staged transactions that come and go."""
    rows = positions(added).withColumn("n", F.lit(1).cast("long"))
    if removed is not None:
        rows = rows.unionByName(positions(removed).withColumn("n", F.lit(-1).cast("long")))
    return rows.groupBy("card_id", "day", "event_date").agg(F.sum("n").alias("n")).where("n <> 0")


def markers(changed: DataFrame) -> DataFrame:
    """(card_id, day, last): the days at which rows came, changed or went, and the last such second."""
    return positions(changed).groupBy("card_id", "day").agg(F.max("epoch").alias("last"))


def same(a: str, b: str, *columns: str) -> Column:
    """Null-safe equality of columns of two aliased tables."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def touched_counts(counts: DataFrame, marks: DataFrame) -> DataFrame:
    """The counts of the marked cards, from the day on before which each has rows enough, or from its first."""
    cards = marks.groupBy("card_id").agg(F.min(F.coalesce("day", F.lit("0001-01-01").cast("date"))).alias("first"))
    earliest, oldest = marks.agg(F.min("day")).first()[0], counts.agg(F.min("day")).first()[0]
    undated = marks.where("day is null").limit(1).count() > 0
    span, side = LOOK_BACK_DAYS, build_side(cards)
    while True:
        part = counts
        if earliest is not None and not undated:
            part = counts.where(F.col("day").isNull() | (F.col("day") >= F.date_sub(F.lit(earliest), span)))
        mine = part.alias("c").join(side.alias("m"), same("c", "m", "card_id")).select("c.*", "m.first")
        if undated or earliest is None or oldest is None or (earliest - oldest).days <= span:
            return mine.drop("first")
        # cards that the part doesn't show to have enough rows before their first change
        before = F.sum(F.when(F.col("day") < F.col("first"), F.col("n")).otherwise(F.lit(0)))
        enough = mine.groupBy("card_id").agg(before.alias("before")).where(F.col("before") >= AMOUNT_ROWS)
        if cards.alias("m").join(enough.alias("e"), same("m", "e", "card_id"), "left_anti").isEmpty():
            return mine.drop("first")
        span *= 4


def needed_days(counts: DataFrame, marks: DataFrame) -> DataFrame:
    """(card_id, day, dirty) of the days to read; ``dirty``: to be recomputed.

    ``counts`` holds the rows of the marked cards after the change.  The windows run
    over a card's days, not its rows.
    """
    days = counts.groupBy("card_id", "day").agg(F.sum("n").alias("n"))
    # a marked day whose rows have all gone has no count
    either = lambda c: F.when(F.col("c.n").isNotNull(), F.col(f"c.{c}")).otherwise(F.col(f"m.{c}")).alias(c)
    rows = (days.alias("c").join(marks.withColumn("marked", F.lit(True)).alias("m"), same("c", "m", "card_id", "day"), "full_outer")
            .select(either("card_id"), either("day"), F.coalesce("c.n", F.lit(0)).alias("n"), "m.last", F.col("m.marked").isNotNull().alias("marked")))
    order = Window.partitionBy("card_id").orderBy("day")
    so_far, ahead = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("upto", F.sum("n").over(so_far)).withColumn("before", F.col("upto") - F.col("n"))
    start = F.unix_timestamp(F.col("day").cast("timestamp"))
    # of the changes so far the latest reaches furthest: fewest rows between, and the last second
    rows = (rows.withColumn("change", F.max(F.when(F.col("marked"), F.col("upto"))).over(so_far))
            .withColumn("second", F.max("last").over(so_far)))
    dirty = F.col("marked") | (F.col("before") - F.col("change") < AMOUNT_ROWS) | (start <= F.col("second") + max(VELOCITY_SECONDS))
    rows = rows.withColumn("dirty", F.coalesce(dirty, F.lit(False)))
    rows = (rows.withColumn("next", F.min(F.when(F.col("dirty"), F.col("before"))).over(ahead))
            .withColumn("next_start", F.min(F.when(F.col("dirty"), start)).over(ahead)))
    context = (F.col("next") - F.col("upto") < AMOUNT_ROWS) | (start + DAY_SECONDS > F.col("next_start") - max(VELOCITY_SECONDS))
    return rows.where(F.col("dirty") | F.coalesce(context, F.lit(False))).select("card_id", "day", "dirty")
