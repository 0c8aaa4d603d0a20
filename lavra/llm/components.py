"""Connected components by alternating stars, in written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.runtime import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """Component of every node of `edges` (columns `src`, `dst`): (`node`, `component`),
    where the component is its smallest node.

    Nodes may be of any ordered type. Loops and repeated edges are allowed; an edge with a
    null end is ignored; no edges give no rows. Every round makes each node point to a smaller
    neighbour, so the number of rounds grows with the logarithm of the longest path, and no
    round has more edges than the one before. All tables stay on the executors: the driver
    only sees an edge count and a checksum per round.
    """
    current = materialize(
        edges.where("src is not null and dst is not null and src <> dst")
        .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .distinct(),
        "components",
    )
    mark = _mark(current)
    while mark[0]:
        current = materialize(_small_star(_large_star(current)), "components")
        before, mark = mark, _mark(current)
        if before == mark:
            break
    nodes = current.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    roots = current.select(F.col("dst").alias("node"), F.col("dst").alias("component"))
    return nodes.unionByName(roots.distinct())


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("check"),
    ).first()
    return row["n"], row["check"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    smallest = both.groupBy("src").agg(F.min("dst").alias("smallest"))
    smallest = smallest.select("src", F.least("src", "smallest").alias("smallest"))
    return (
        both.join(smallest, "src")
        .where("dst > src")
        .select(F.col("dst").alias("src"), F.col("smallest").alias("dst"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy("src").agg(F.min("dst").alias("smallest"))
    others = edges.join(smallest, "src").where("dst <> smallest")
    return (
        others.select(F.col("dst").alias("src"), F.col("smallest").alias("dst"))
        .unionByName(smallest.select("src", F.col("smallest").alias("dst")))
        .distinct()
    )
