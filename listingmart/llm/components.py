"""Connected components of an edge list by alternating large and small stars.

Each half-step replaces edges by edges to the smallest neighbour, until every
node points at its component's smallest node. A node with very many edges only
meets its own minimum (pre-aggregated before the shuffle, written, and joined
on, so that adaptive execution may split the node's edges).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingmart.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges if not large else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "cc-min")
    met = both.join(least, "u")
    # large: larger neighbours go to the minimum; small: the smaller ones, and the node itself
    moved = (met.filter("v > u") if large else met).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], int(r[1] or 0)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node of its component."""
    cur = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    cur = stored(cur, "cc-edges")
    before = _state(cur)
    while before[0]:
        cur = stored(_star(stored(_star(cur, large=True), "cc-large"), large=False), "cc-small")
        after = _state(cur)
        if after == before:
            break
        before = after
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
