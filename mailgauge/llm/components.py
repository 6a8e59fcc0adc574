"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailgauge.sources.scratch import gathered, land, remove


def _least(neighbours: DataFrame) -> DataFrame:
    """The least of each node's neighbours and itself, by node."""
    return neighbours.groupBy("node").agg(F.least(F.min("other"), "node").alias("least"))


def _large(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to its least neighbour."""
    both = links.union(links.select("b", "a")).toDF("node", "other")
    least = _least(both)
    # Only larger neighbours are moved; the join is by node, whose least is one row.
    moved = both.filter("other > node").join(least, "node")
    return moved.select(F.col("other").alias("a"), F.col("least").alias("b")).distinct()


def _small(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).filter("node <> other")
    least = _least(down)
    moved = down.join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    heads = least.select(F.col("node").alias("a"), F.col("least").alias("b"))
    return moved.union(heads).filter("a <> b").distinct()


def connected_components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """node, root: every node that has a link, and the least node its links reach.

    ``links`` has columns a and b.  Nodes are totally ordered values.  A round
    ends in a stored table, so that lineage stays short and a lost executor
    costs one round; the one before is deleted.  Rounds grow with the logarithm of the nodes.  Minima are
    taken before the shuffle, and a node with very many links meets a single
    row in the join, where adaptive execution splits it.  Links never become
    more, so a round makes no more files than the links before it ask for.
    """
    current = land(links.select("a", "b").filter("a <> b").distinct())
    seen, most = None, current.count()
    for _ in range(max_rounds):
        following = land(gathered(_small(_large(current)), most))
        state = tuple(following.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())
        remove(current)
        if state == seen:
            heads = following.select("b", "b").distinct()
            return following.union(heads).toDF("node", "root")
        seen, most, current = state, state[0], following
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
