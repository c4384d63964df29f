"""Connected components of a link table, by contraction.

Each round hooks every node to its smallest neighbour, follows these pointers to
their ends and replaces the links by links between ends.  A chain of pointers
halves with each jump and a round leaves at most half of the linked nodes, so
rounds and jumps grow with the logarithm of the links.  Every step is a join or an
aggregate over tables in the shared folder; nothing is collected but counts.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b); component: its smallest reachable id.

    Links from a node to itself and repeated links change nothing; links with a
    null end are not links.
    """
    edges = links.select("a", "b").where("a <> b")
    labels = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")).select(F.col("a").alias("id"), "p"), "hooks")
        if not hooks.take(1):
            break
        while True:  # pointers point to smaller ids only, so they have no cycle
            up = hooks.select(F.col("id").alias("p"), F.col("p").alias("q"))
            jumped = stored(hooks.join(up, "p").select("id", F.col("q").alias("p"), (F.col("q") != F.col("p")).alias("moved")), "jumps")
            hooks = jumped.select("id", "p")
            if not jumped.where("moved").take(1):
                break
        if labels is None:
            labels = hooks
        else:
            root = hooks.select(F.col("id").alias("p"), F.col("p").alias("q"))
            labels = stored(labels.join(root, "p", "left").select("id", F.coalesce("q", "p").alias("p")), "labels")
        ends = hooks.select(F.col("id").alias("a"), F.col("p").alias("pa"))
        other = hooks.select(F.col("id").alias("b"), F.col("p").alias("pb"))
        edges = stored(edges.join(ends, "a").join(other, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b")).where("a <> b").distinct(), "links")
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels.select("id", F.col("p").alias("component"))
