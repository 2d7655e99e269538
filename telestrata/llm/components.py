"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telestrata.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``edges(a, b)`` but the roots themselves.

    The root is the smallest node of the component. A round links every node to the
    smallest of its neighbours, first the larger neighbours of a node, then the smaller
    ones; the rounds end when only stars are left, after about the logarithm of the longest
    chain. A node's neighbours are only ever aggregated and joined, never gathered, and
    each round is written to the shared folder. Loops and nulls are ignored.
    """
    now = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    while not _only_stars(now):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").selectExpr("v as u", "m as v")
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").selectExpr("v as u", "m as v")
        now = stored(small.union(least.selectExpr("u", "m as v")).distinct(), "links")
    return now.selectExpr("u as node", "v as root")


def _only_stars(links: DataFrame) -> bool:
    """Every node has one smaller neighbour, which has none itself."""
    several = links.groupBy("u").count().where("count > 1").limit(1)
    inner = links.join(links.selectExpr("v as u").distinct(), "u", "left_semi").limit(1)
    return several.isEmpty() and inner.isEmpty()
