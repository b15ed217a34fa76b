"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise

#: Rounds grow with the logarithm of the longest path; this is far beyond any.
ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("of"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("of")).selectExpr("v as u", "m as v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.selectExpr("greatest(u, v) as u", "least(u, v) as v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    across = down.join(least.withColumnRenamed("u", "of"), F.col("u") == F.col("of"))
    return (
        across.where("v <> m").selectExpr("v as u", "m as v").union(least.selectExpr("u", "m as v")).distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the least node that each linked node reaches.

    ``links`` has the long columns ``u, v``; direction, repeats and loops don't
    matter, rows with a null are no links. Only nodes of a link to another node
    appear. Each round is aggregates and joins by node, so a node with very many
    links is never gathered, and is written out before the next.
    """
    edges = materialise(
        links.where("u <> v").selectExpr("greatest(u, v) as u", "least(u, v) as v").distinct(), "links"
    )
    if edges.isEmpty():
        return edges.selectExpr("u as node", "v as root")

    def state(df: DataFrame) -> tuple:
        hashed = F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))
        return tuple(df.agg(F.count("*"), F.sum(hashed)).first())

    now = state(edges)
    for _ in range(ROUNDS):
        last, edges = edges, materialise(_small_star(_large_star(edges)), "star")
        discard(last)
        before, now = now, state(edges)
        if now == before:
            return edges.selectExpr("u as node", "v as root")
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
