"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm.common import store


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) to (node, component), the component being its smallest node.

    Each round links every larger neighbour to the smallest one, then every
    smaller one, until all nodes point at their component's smallest. Neighbour
    lists are never gathered; minima are combined before the shuffle, and a node
    of many edges is split by adaptive joins. Self-loops and null ends tell
    nothing and give no node; repeated edges count once.
    """
    now = store(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state = None
    while True:
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first()
        if seen == state or seen[0] == 0:
            break
        state = seen
        now = store(_small_star(store(_large_star(now), "large-star")), "small-star")
    smallest = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return smallest.unionAll(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Stored, so that the join deals out its own sides and can split a node of many edges.
    least = store(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = store(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    others = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionAll(least.select("a", F.col("m").alias("b"))).distinct()
