"""Connected components by alternating large-star and small-star.

Links are a table; every step writes its result to the shared folder, so lineage stays short
and lost executors cost one step. No node's neighbours are gathered: a step takes the smallest
neighbour per node and joins it back. Both sides of that join are read from tables, so Spark
can split a hub's rows over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def _least(pairs: DataFrame) -> DataFrame:
    return materialize(pairs.groupBy("u").agg(F.min("v").alias("m")), "star-least")


def large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    far = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return materialize(far.where("u <> v").distinct(), "large-star")


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    near = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    links = near.where("u <> v").union(least.select("u", F.col("m").alias("v")))
    return materialize(links.distinct(), "small-star")


def _is_star_forest(edges: DataFrame) -> bool:
    """True if every node has one root, and no root has a root: no step changes that."""
    ends = edges.select("u", F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("u").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return nodes.where("below > 1 or (below = 1 and above = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that is not its own root; the root is the smallest node.

    ``edges`` has columns u and v of one type, u <> v, in any direction, and is a written table.
    """
    while True:
        edges = small_star(large_star(edges))
        if _is_star_forest(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def extended(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """``roots`` of ``components`` after more ``edges``; both are written tables.

    Only the roots that the new edges join are linked again, not the components below them.
    """
    ends = edges.join(_as(roots, "u", "ru"), "u", "left").join(_as(roots, "v", "rv"), "v", "left")
    ends = ends.select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v"))
    ends = materialize(ends.where("u <> v").distinct(), "root-links")
    moved = components(ends)
    below = roots.join(_as(moved, "root", "to"), "root", "left")
    below = below.select("node", F.coalesce("to", "root").alias("root"))
    return materialize(below.union(moved), "roots")


def _as(roots: DataFrame, node: str, root: str) -> DataFrame:
    return roots.select(F.col("node").alias(node), F.col("root").alias(root))
