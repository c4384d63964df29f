"""Mixing sources to target weights, in DataFrame expressions only.

Sources are leaves of a tree domain - language - source.  A token budget is split
from the root down by the children's weights.  A child takes no more than its
subtree can give (its tokens times ``max_epochs``); what it leaves goes to its
siblings by weight, and only what a whole subtree can't use reaches the level
above, because a subtree's capacity is the sum of its leaves.  Within a node this
is water filling: children in order of capacity per weight, each saturated as long
as the level that saturates it costs no more than the budget.  All amounts are
integers, so the split doesn't depend on an order of additions; the remainder of an
integer division (less than one token for each child) is left unused.

A leaf's budget is a number of whole epochs and a prefix of one more.  An epoch's
order is the md5 of (seed, epoch, the row's key), so rows that share an id or have none spread like all others.  The prefix sums behind the cut are
taken in hash ranges of each leaf, so that no leaf is sorted by one task.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import prepare, row_hash, stored, whole_rows

BIG = "decimal(38,0)"
BUCKET_ROWS = 50_000
LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class Weights:
    """Integer weights by name for each level of the tree; unnamed children get ``other``."""

    domain: dict[str, int] = field(default_factory=dict)
    lang: dict[str, int] = field(default_factory=dict)
    source: dict[str, int] = field(default_factory=dict)
    other: int = 1

    def column(self, level: str) -> Column:
        named = getattr(self, level)
        if not named:
            return F.lit(self.other).cast(BIG)
        pairs = [F.lit(x) for k, v in sorted(named.items()) for x in (k, v)]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(level)), F.lit(self.other)).cast(BIG)


def water_fill(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds ``got`` to (parent columns, name, weight, capacity, budget): each child's
    share of its parent's budget.  Children without weight get nothing."""
    give = F.when(F.col("weight") > 0, F.col("capacity")).otherwise(F.lit(0).cast(BIG))
    rows = children.withColumn("give", give).withColumn("ratio", F.when(F.col("weight") > 0, F.col("capacity").cast("double") / F.col("weight").cast("double")).otherwise(F.lit(-1.0)))
    # the children of one node: one row for each source at most, never documents
    order = Window.partitionBy(*parent).orderBy("ratio", name)
    before, onward, all_ = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy(*parent)
    big = lambda c: c.cast(BIG)
    rows = (rows.withColumn("used", big(F.coalesce(F.sum("give").over(before), F.lit(0)))).withColumn("open", big(F.sum("weight").over(onward)))
            .withColumn("full", (F.col("weight") <= 0) | (big(F.col("used") * F.col("weight")) + big(F.col("give") * F.col("open")) <= big(F.col("budget") * F.col("weight")))))
    rows = (rows.withColumn("spent", big(F.sum(F.when(F.col("full"), F.col("give")).otherwise(F.lit(0))).over(all_)))
            .withColumn("sharing", big(F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(F.lit(0))).over(all_))))
    exact = F.expr(f"cast(cast((budget - spent) * weight as {BIG}) div sharing as {BIG})")
    return rows.withColumn("got", F.when(F.col("full"), F.col("give")).otherwise(exact)).drop("give", "ratio", "used", "open", "full", "spent", "sharing")


def leaf_budgets(leaves: DataFrame, weights: Weights, budget: int, max_epochs: int) -> DataFrame:
    """(domain, lang, source, docs, tokens, epochs, rest) from the leaves' docs and tokens."""
    tree = leaves.withColumn("capacity", (F.col("tokens") * max_epochs).cast(BIG))
    above = None
    for depth, level in enumerate(LEVELS):
        path = list(LEVELS[:depth])
        nodes = tree.groupBy(*path, level).agg(F.sum("capacity").cast(BIG).alias("capacity")).withColumn("weight", weights.column(level))
        nodes = nodes.withColumn("budget", F.lit(budget).cast(BIG)) if above is None else nodes.join(above, path)
        filled = water_fill(nodes.withColumn("root", F.lit(0)), path or ["root"], level)
        above = filled.select(*path, level, F.col("got").alias("budget"))
    got = F.col("budget").cast("long")
    return (leaves.join(above, list(LEVELS)).withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("cast(budget as bigint) div tokens")).otherwise(F.lit(0)).cast("long"))
            .withColumn("rest", got - F.col("epochs") * F.col("tokens")).drop("budget"))


def word_count(text: str = "text") -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def mixture(docs: DataFrame, domain: Column, weights: Weights, budget_permille: int = 600, max_epochs: int = 4, seed: int = 1) -> DataFrame:
    """(key, doc_id, domain, lang, source, n_tokens, copies) for each different row
    of ``docs`` (doc_id, text, lang, source); tokens are words.

    copies: how often the mixture holds the row.  A null language, source or domain
    is the child "unknown"; rows equal in these columns are one with their sum
    of tokens and are taken together.  Rows with equal id and different texts are
    rows of their own, and these and rows without id spread over the hash ranges like
    all others.  Texts without words cost nothing: they come with each epoch.
    Long texts count all their words; other columns are not read.  An empty table
    gives no rows.
    """
    prepare(docs.sparkSession)
    name = lambda c: F.coalesce(c.cast("string"), F.lit("unknown"))
    sized = docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), name(domain).alias("domain"),
                        name(F.col("lang")).alias("lang"), name(F.col("source")).alias("source"), word_count().alias("n"))
    rows = stored(sized.groupBy("key", "doc_id", *LEVELS).agg(F.max("n").alias("n_tokens"), F.sum("n").alias("cost")), "sized")
    total = rows.agg(F.sum("cost")).first()[0] or 0
    leaves = stored(rows.groupBy(*LEVELS).agg(F.count("*").alias("docs"), F.sum("cost").alias("tokens")), "leaves")
    plan = stored(leaf_budgets(leaves, weights, total * budget_permille // 1000, max_epochs), "budgets")
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col("epochs") + 1).cast("string"), F.col("key")))
    placed = rows.join(plan, list(LEVELS)).withColumn("mark", mark)
    buckets = F.ceil(F.col("docs") / BUCKET_ROWS).cast("long")
    # a hash's range: its first 32 bits scaled to the leaf's number of ranges, so ranges follow the order of the marks
    head = F.conv(F.substring("mark", 1, 8), 16, 10).cast("long")
    placed = placed.withColumn("bucket", F.shiftrightunsigned(head * buckets, 32))
    leaf = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy(*LEVELS, "bucket").agg(F.sum("cost").alias("sum"))
              .withColumn("start", F.coalesce(F.sum("sum").over(leaf), F.lit(0))).drop("sum"))
    inner = Window.partitionBy(*LEVELS, "bucket").orderBy("mark", "key").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("cost").over(inner), F.lit(0))
    copies = F.col("epochs") + F.when(before < F.col("rest"), 1).otherwise(0)
    return placed.join(starts, [*LEVELS, "bucket"]).select("key", "doc_id", *LEVELS, "n_tokens", copies.alias("copies"))


def row_key() -> Column:
    """Equal for rows with equal id, text, language and source."""
    return row_hash("doc_id", "text", "lang", "source")


def mixed(docs: DataFrame, domain: Column, weights: Weights, **options) -> DataFrame:
    """The mixture itself: each row of ``docs`` as often as its copies say."""
    chosen = mixture(docs, domain, weights, **options).where("copies > 0").select(F.col("key").alias("mix_key"), F.col("copies").alias("mix_copies"))
    rows = docs.select(whole_rows(docs), row_key().alias("mix_key")).join(chosen, "mix_key")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies")))).select("row.*")
