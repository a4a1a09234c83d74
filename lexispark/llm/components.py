"""Connected components of a link table by contraction; links and nodes stay in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.session import materialise


def _roots(parent: DataFrame) -> DataFrame:
    """``node, to`` where ``to`` is the end of the chain of ``parent`` links (``to`` is smaller than ``node``)."""
    while True:
        a, b = parent.alias("a"), parent.alias("b")
        jumped = a.join(b, F.col("a.to") == F.col("b.node"), "left").select(
            F.col("a.node").alias("node"), F.coalesce("b.to", "a.to").alias("to"), F.col("b.to").isNotNull().alias("moved")
        )
        parent = materialise(jumped)
        if parent.where("moved").isEmpty():
            return parent.select("node", "to")
        parent = parent.select("node", "to")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node with a link to another one; ``component`` is the smallest node reachable.

    Each round hangs every node below its smallest neighbour, follows these links to their ends and renames the links;
    what is left are links between fewer ends. Repeated links, links of a node to itself and an empty table are fine.
    """
    x, y = F.col(f"`{a}`"), F.col(f"`{b}`")
    rest = materialise(links.where(x != y).select(F.greatest(x, y).alias("node"), F.least(x, y).alias("to")).distinct())
    known = None
    while not rest.isEmpty():
        ends = _roots(materialise(rest.groupBy("node").agg(F.min("to").alias("to"))))
        if known is None:
            small = rest.select(F.col("to").alias("node")).distinct().join(ends, "node", "left_anti")
            known = ends.unionByName(small.select("node", F.col("node").alias("to")))
        else:
            known = known.alias("k").join(ends.alias("e"), F.col("k.to") == F.col("e.node"), "left").select("k.node", F.coalesce("e.to", "k.to").alias("to"))
        known = materialise(known)
        e, f = ends.alias("e"), ends.alias("f")
        named = (
            rest.alias("r").join(e, F.col("r.node") == F.col("e.node"), "left").join(f, F.col("r.to") == F.col("f.node"), "left")
            .select(F.coalesce("e.to", "r.node").alias("p"), F.coalesce("f.to", "r.to").alias("q"))
        )
        rest = materialise(named.where("p <> q").select(F.greatest("p", "q").alias("node"), F.least("p", "q").alias("to")).distinct())
    if known is None:
        return rest.select("node", F.col("to").alias("component"))
    return known.select("node", F.col("to").alias("component"))
