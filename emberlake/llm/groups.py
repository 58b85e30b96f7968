"""Connected groups of a large edge list: union-find inside each partition, then star contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import written


def _forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over the edges of one partition; gives each node with the least node of its tree."""
    parent: dict = {}

    def root(node):
        top = node
        while parent[top] != top:
            top = parent[top]
        while parent[node] != top:
            parent[node], node = top, parent[node]
        return top

    for batch in batches:
        for a, b in zip(batch["u"], batch["v"], strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = [x for x in parent if root(x) != x]
    yield pd.DataFrame({"u": nodes, "v": [parent[x] for x in nodes]}, dtype=object)


def _large_stars(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_stars(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them. ``edges`` point downwards."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionByName(least.select("u", F.col("m").alias("v")))


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) that isn't the least of its group.

    Each round is two joins on the node with map-side combined minima; rounds grow with the logarithm of the
    longest path. Every round is a written table, compared by count and hash sum with the one before.
    """
    schema = edges.select("u", "v").schema
    stars = written(edges.select("u", "v").mapInPandas(_forests, schema).distinct(), "forests")
    mark = None
    while True:
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
        stars = written(_small_stars(_large_stars(stars).distinct()).distinct(), "stars")
