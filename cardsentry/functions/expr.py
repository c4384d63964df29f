"""Small aggregate/expression helpers shared by marts and reports."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# Money is summed in decimals so totals do not depend on partitioning or task
# retry order; ten places hold the minor units of every currency.  The result is
# returned as DOUBLE like the source column.
MONEY = "decimal(28,10)"


def count_if(cond: Column) -> Column:
    """Number of rows where ``cond`` is true, as BIGINT."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def money_sum(value: Column, cond: Column | None = None) -> Column:
    v = value.cast(MONEY)
    if cond is not None:
        v = F.when(cond, v).otherwise(F.lit(0).cast(MONEY))
    return F.sum(v).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """``num / nullif(den, 0)`` as DOUBLE (NULL for a zero denominator)."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def pct(num: Column, den: Column) -> Column:
    return F.lit(100.0) * num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def rounded_mean(value: Column, in_scale: int, out_scale: int) -> Column:
    """Mean of a fixed-point quantity rounded half-up to ``out_scale`` places,
    computed exactly in integers (sum of units, count), so the result does not
    depend on summation order or partitioning.  ``in_scale`` is the number of
    decimals the values carry (2 for cents, 0 for integers)."""
    units = F.round(value * (10 ** in_scale)).cast("bigint")
    s = F.sum(units).cast("decimal(38,0)")
    n = F.count(units).cast("decimal(38,0)")
    num = s * (10 ** (out_scale - in_scale)) if out_scale >= in_scale else s
    den = n if out_scale >= in_scale else n * (10 ** (in_scale - out_scale))
    q = F.floor((F.abs(num) * 2 + den) / (den * 2)) * F.signum(num).cast("decimal(38,0)")
    return F.when(n > 0, q.cast("double") / float(10 ** out_scale))


#: Rows up to which a join's stored side is broadcast.
BUILD_ROWS = 100_000


def build_side(df):
    """The right side of a join with a stored table: broadcast if it has at most
    ``BUILD_ROWS`` rows, else sorted and merged.  Left to itself, the planner goes by the
    size of the compressed files, where a narrow row may take a byte, and builds a table
    of millions of rows on the driver.  Rows of stored tables are counted from footers."""
    return F.broadcast(df) if df.count() <= BUILD_ROWS else df.hint("merge")


def broadcast_if_small(df, max_rows: int = 1_000_000):
    """Broadcast ``df`` only after checking it has at most ``max_rows`` rows;
    beyond that it is returned as is and the planner shuffles (AQE may still
    switch to a broadcast from runtime sizes).  The check reads at most
    ``max_rows + 1`` rows, whatever the table size."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
