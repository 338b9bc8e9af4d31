"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.scratch import save


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of any orderable type -> (node, component), component the least node reachable.

    Nodes without a link to another are left out. Every step keeps a row per link at most and reduces map-side, so a
    node with very many links is one row per task; links pass through no driver. Each round is written to the shared
    folder. Rounds grow with the logarithm of the longest chain.
    """
    edges = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = save(edges.distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("least"))
        large = (
            both.where(F.col("b") > F.col("a"))
            .join(nearest, "a")
            .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (
            large.join(lowest, "a")
            .select(F.explode(F.array(F.struct("b", "least"), F.struct(F.col("a").alias("b"), "least"))).alias("e"))
            .select(F.col("e.b").alias("a"), F.col("e.least").alias("b"))
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
        edges = save(small)
        new = _state(edges)
        if new == state:
            break
        state = new
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
