"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stategrid.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a long, b long); the
    component is its smallest node. Each step's links are written to the
    shared checkpoint folder, so a lost executor does not replay the rounds.
    A node's links are only ever reduced (min) or joined, never gathered."""
    e = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where(F.col("a") != F.col("b")).distinct(), "links")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("n"), F.least("a", "m").alias("m"))
        # large star: every larger neighbour links to the smallest of the neighbourhood
        large = (both.where(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("n"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where(F.col("a") != F.col("b")).distinct())
        # small star: a node and its smaller neighbours link to the smallest of them
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = (large.join(small.withColumnRenamed("a", "n"), F.col("a") == F.col("n"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where(F.col("a") != F.col("b")))
        e = materialize(moved.unionByName(small.withColumnRenamed("m", "b")).distinct(), "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
