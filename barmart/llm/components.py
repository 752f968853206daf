"""Connected components of an edge table, by alternating star steps; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmart.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """(a, b) rows to (vertex, root): the smallest vertex that can be reached. Vertices without an edge have no row.

    Each round points every vertex and its neighbours at the smallest vertex among them (large star, then small star); the
    rounds grow with the logarithm of the longest path. Minima are combined before each exchange, and joins on a vertex with
    very many edges are split by adaptive execution.
    """
    pairs = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges"
    )
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        pairs = stored(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b")
            .union(small.select("a", F.col("m").alias("b")))
            .distinct(),
            "edges",
        )
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return pairs.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
        before = now
