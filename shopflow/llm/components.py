"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above u is linked to u's smallest neighbour or u."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.filter("b > a").join(low, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below u, and u, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(low, "a")
    return (hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id in ``edges``: component is the smallest
    id it is connected to.  Self-links, repeats and nulls are allowed (nulls
    are ignored; an id with only self-links is not returned).

    Each round is one large-star and one small-star step, O(edges) rows each;
    rounds grow with the logarithm of the longest path.  Rounds are written
    to the shared folder, so a lost executor costs one round at most."""
    now = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
                  .filter("a is not null and b is not null and a <> b").distinct(), "edges")
    sums = None
    while True:
        now = written(_small_star(_large_star(now)), "edges")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if sums is not None and tuple(new) == sums:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        sums = tuple(new)
