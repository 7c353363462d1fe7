"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored


EDGES = 100_000  # in a partition of a stored round


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a").agg(F.min("b").alias("least"))


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``links (a, b)``; the least node names it.

    Each round joins every node's larger, then its smaller, neighbours to its
    least neighbour, and stores the result; rounds grow with the logarithm of
    the longest chain.  Minima are partial sums by task and the join back is an
    ordinary skew-safe one, so a node with very many links is no hot group.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    # a contraction has at most twice as many edges; small tables are kept in few files
    parts = 1 + links.count() // EDGES
    edges = stored(edges.coalesce(parts))
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_least(both), "a").where("b > a") \
            .select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()
        small = large.join(_least(large), "a") \
            .select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b") \
            .unionByName(_least(large).withColumnRenamed("least", "b")).distinct()
        edges = stored(small.coalesce(parts))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionByName(roots.select("node", F.col("node").alias("component")))
