"""Connected components of a link table, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import keep


def _first(node: str) -> Column:
    """Nodes in an order without long descents, whatever their names: by hash."""
    return F.min(F.struct(F.xxhash64(node).alias("hash"), F.col(node).alias("node")))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node with a link; a component's name is its smallest node.

    Each round, every node moves to the first by hash among itself and its neighbours, and on to where
    that one moved. Links are renamed at both ends, loops and repeats dropped, so that nodes and links shrink
    by a factor each round and the rounds grow with the logarithm of the largest component. Minima
    are taken before the shuffle. Every round is written, so no lineage builds up.
    """
    ends = (F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    edges = keep(links.select(*ends).where("a < b").distinct(), "edges")
    names = None
    while edges.take(1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        own = F.struct(F.xxhash64("a").alias("hash"), F.col("a").alias("node"))
        moved = both.groupBy("a").agg(_first("b").alias("next")).select("a", F.least(own, F.col("next"))["node"].alias("to"))
        moved = keep(moved, "moved")
        on = moved.select(F.col("a").alias("to"), F.col("to").alias("further"))
        step = keep(moved.join(on, "to").select("a", F.col("further").alias("to")), "step")
        renamed = edges.join(step, "a").select("b", F.col("to").alias("x"))
        renamed = renamed.join(step.withColumnRenamed("a", "b"), "b").select("x", F.col("to").alias("y"))
        edges = keep(renamed.select(*ends).where("a < b").distinct(), "edges")
        if names is None:
            names = step.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            later = step.select(F.col("a").alias("root"), "to")
            names = names.join(later, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        names = keep(names, "names")
    if names is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # the node that a component was drawn together to is one of its nodes
    least = names.groupBy("root").agg(F.min("node").alias("component"))
    return keep(names.join(least, "root").select("node", "component"), "components")
