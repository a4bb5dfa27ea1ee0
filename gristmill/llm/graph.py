"""Connected components by alternating large-star and small-star rounds.

Each round is an aggregate and a join; nothing is held on the driver. Every round's edges are
written to the shared folder, so that a lost executor repeats one round only, and dropped when the
next round's are written. The rounds end when the edges are stars already, after about log^2 of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.session import cut, drop


def _directed(edges: DataFrame) -> DataFrame:
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.select("a", "b").unionByName(back)


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, larger id first."""
    a, b = F.greatest("a", "b"), F.least("a", "b")
    return edges.where(F.col("a") != F.col("b")).select(a.alias("a"), b.alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = _directed(edges)
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    far = both.where(F.col("b") > F.col("a")).join(low, "a")
    return _ordered(far.select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    near = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(near.unionByName(low.select("a", F.col("m").alias("b"))))


def _print(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.bit_xor(F.xxhash64(F.lit(1), h))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of `edges` (a, b): the smallest id that it reaches."""
    now = cut(_ordered(edges), "components")
    seen = _print(now)
    while True:
        large = cut(_large_star(now), "components")
        drop(now)
        now = cut(_small_star(large), "components")
        drop(large)
        after = _print(now)
        if after == seen:
            break
        seen = after
    roots = now.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
