"""Connected components of links, by distributed union-find.

Alternating large-star and small-star steps hang every node below smaller ones
until each component is a star around its least node.  Each step is a grouped
minimum (with partial aggregation) and a join; no neighbour list is ever
collected, so a node may have any number of links.  Beyond ``HUB_EDGES`` edges
the nodes of many links are joined by broadcast, so that none is a hot key.
Each round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, discard, join_by_size

#: Up to so many edges, all of one node's fit in a task.
HUB_EDGES = 1_000_000


def _with_least(edges: DataFrame, n: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(edges with m, the least neighbour of a; (a, m) of each node; the stored table behind them)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("_n"))
    if n <= HUB_EDGES:
        least = least.drop("_n")
        return edges.join(least, "a"), least, None
    least = cut(least, "least")
    return join_by_size(edges, least, ["a"]), least.drop("_n"), least


def _large_star(edges: DataFrame, n: int) -> tuple[DataFrame, DataFrame | None]:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined, _, stored = _with_least(both, 2 * n)
    joined = joined.withColumn("m", F.least("a", "m"))
    return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), stored


def _small_star(edges: DataFrame, n: int) -> tuple[DataFrame, DataFrame | None]:
    joined, least, stored = _with_least(edges, n)
    rest = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (long columns a, b); a component's name is its least node."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut(edges, "edges")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state or not now[0]:
            break
        state = now
        middle, first = _large_star(edges, now[0])
        if first is not None:
            middle = cut(middle, "edges")
        after, second = _small_star(middle, now[0])
        after = cut(after, "edges")
        discard(edges, middle, first, second)
        edges = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
