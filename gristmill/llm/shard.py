"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source and get the fractional rank
(rank - 1/2) / rows of the source. Sorted by it, all sources are interleaved in proportion
everywhere, so equal contiguous cuts all have the mixture of the whole table and sizes that differ
by one row at most.

Both ranks are computed without one task per source or for the whole table: the shuffle hash and the
fractional rank are cut into ranges, ranges are counted, and a row's rank is the number of rows in
earlier ranges plus its place in its own. The range counts are the only thing summed in order.

Rows: a null source is a stratum of its own. Rows that agree in every key column are ordered by
text, and full copies are interchangeable. A table without rows gives no rows. Extra columns are
not carried along; use `doc_id` to join them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.llm.common import parts

# Rows of one range, the unit that a task sorts.
RANGE_ROWS = 1000
# Ranges of one block of running totals.
BLOCK = 1024


def _running(counts: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows in earlier ranges, for each range. Ranges are summed in blocks first, so that a task
    sums a block, or the blocks' totals, and never all ranges."""
    counts = counts.withColumn("block", F.floor(F.col(order) / BLOCK))
    blocks = counts.groupBy(*by, "block").agg(F.sum("n").alias("n"))
    far = W.partitionBy(*by).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(*by, "block", F.coalesce(F.sum("n").over(far), F.lit(0)).alias("far"))
    near = W.partitionBy(*by, "block").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("near", F.coalesce(F.sum("n").over(near), F.lit(0)))
    before = (F.col("far") + F.col("near")).alias("before")
    return counts.join(blocks, [*by, "block"]).select(*by, order, before)


def interleave(
    docs: DataFrame,
    n_shards: int,
    id_col: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: int = 0,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """doc_id, source, size, text_crc32, position, shard and slot of every row.

    The order within a source depends on `seed`, the id and the text alone, so a repeated run and a
    recomputed task give the same shards.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source).alias("source"),
        (F.octet_length(t) + 16).cast("long").alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(seed), F.col(id_col), t).alias("h"),
    )
    total = rows.count()
    ranges = parts(total, range_rows)
    rows = rows.withColumns(
        {
            "stratum": F.coalesce(F.concat(F.lit("="), "source"), F.lit("")),
            # the unsigned upper half of the hash, cut into equal ranges
            "r": F.floor(F.shiftrightunsigned("h", 32) * ranges / F.lit(1 << 32)),
        }
    )
    tie = ["h", "doc_id", "size", "text_crc32"]
    counts = rows.groupBy("stratum", "r").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("stratum").agg(F.sum("n").alias("of"))
    before = _running(counts, ["stratum"], "r").join(totals, "stratum")
    place = F.row_number().over(W.partitionBy("stratum", "r").orderBy(*tie))
    ranked = rows.withColumn("place", place).join(before, ["stratum", "r"])
    # (rank - 1/2) / rows as an exact fraction: odd / even
    ranked = ranked.withColumn("odd", 2 * (F.col("before") + F.col("place")) - 1).withColumn(
        "fraction", F.col("odd") / (2 * F.col("of"))
    )
    ranked = ranked.select(
        "doc_id", "source", "size", "text_crc32", "h", "stratum", "fraction",
        F.floor(F.col("fraction") * ranges).alias("q"),
    )
    counts = ranked.groupBy("q").agg(F.count(F.lit(1)).alias("n"))
    before = _running(counts, [], "q")
    place = F.row_number().over(W.partitionBy("q").orderBy("fraction", "stratum", *tie))
    position = F.col("before") + F.col("place") - 1
    shard = _div(position * n_shards, F.lit(max(total, 1)))
    first = _div(shard * total + (n_shards - 1), F.lit(n_shards))
    return (
        ranked.withColumn("place", place)
        .join(before, "q")
        .select(
            "doc_id",
            "source",
            "size",
            "text_crc32",
            position.alias("position"),
            shard.cast("int").alias("shard"),
            (position - first).alias("slot"),
        )
    )


def _div(a: Column, b: Column) -> Column:
    """Division of whole numbers: cuts stand at ceil(k * total / n), exactly."""
    return F.call_function("div", a, b)
