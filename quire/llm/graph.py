"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, component (the smallest node reachable) for the nodes of edges (a, b: long).

    Alternates the large-star and small-star steps, which keep the number of edges near that of nodes; each round is
    written to the shared folder, so that a lost executor costs one round. Minima are combined before each shuffle, and
    the joins on a hub leave its rows on the side that adaptive execution can split. Loops and repeated edges are
    allowed, null ends are not. No edges: no rows.
    """
    a, b = F.col("a"), F.col("b")
    now = materialize(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), name)
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if state == before or not state.n:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()).groupBy("node").agg(F.min("component").alias("component"))
        before = state
        ends = now.union(now.select(b.alias("a"), a.alias("b")))
        least = ends.groupBy("a").agg(F.min("b").alias("m")).select(a.alias("b"), F.least(a, F.col("m")).alias("m"))
        large = now.join(least, "b").select("a", F.col("m").alias("b")).where(a != b)
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b")).union(lowest.select("a", F.col("m").alias("b")))
        now = materialize(small.distinct(), name)
