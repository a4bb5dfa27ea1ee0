"""Benchmark decontamination: SimHash over item-sized windows, Hamming blocks, exact check.

A window has as many words as its item. Windows are set where text and item share a five-word
shingle, aligned at the shared shingle: a window without any shared shingle has similarity zero. The
fingerprint of each window and item is a 64-bit SimHash of its shingles. Fingerprints are cut into
radius + 1 blocks, so any two within the radius agree in one block at least; the equality join on
(item, block, value) finds them all. The found windows are then compared exactly by weighted
shingles: the sum of the smaller counts over the sum of the larger ones, over the shingles of both.

Fingerprints at a similarity of 0.8 differ in about 10 of 64 bits; 1 in 5000 differs in more than
the default radius of 20.

Verdicts belong to texts: equal texts have equal verdicts, and repeated rows are judged alike. Null
and empty texts, and texts or items with fewer words than a shingle, match by their whole word
sequence only. Null item ids are items too. Extra columns are carried along. No items, no matches;
no rows in, none out. Only DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import bind, named, spread
from gristmill.llm.minhash import LOWER, UPPER
from gristmill.llm.quality_rules import words
from gristmill.session import broadcast_if_small, cut

RADIUS = 20
BITS = 64


def sequence(text: Column, n: int) -> Column:
    """Hashes of all n-word shingles in order, repeats included; whole sequence if shorter."""

    def of(w: Column) -> Column:
        many = F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - (n - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, n)]),
        )
        short = F.array(F.xxhash64(F.lit(n), F.array_join(w, " ")))
        none = F.array().cast("array<bigint>")
        return F.when(F.size(w) == 0, none).when(F.size(w) < n, short).otherwise(many)

    return bind(words(F.translate(text, UPPER, LOWER)), of)


def simhash(hashes: Column) -> Column:
    """64-bit SimHash of an array of hashes, each as heavy as it is frequent."""

    def bit(b: Column) -> Column:
        ones = F.aggregate(
            hashes, F.lit(0), lambda a, h: a + F.call_function("getbit", h, b)
        )
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), b)
        return F.when(2 * ones > F.size(hashes), one).otherwise(F.lit(0).cast("bigint"))

    each = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), bit)
    return F.aggregate(each, F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x))


def blocks(fingerprint: Column, radius: int) -> Column:
    """(block, value) of each of radius + 1 runs of bits."""
    edges = [BITS * k // (radius + 1) for k in range(radius + 2)]
    return F.array(
        *[
            F.struct(
                F.lit(k).alias("block"),
                F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"),
            )
            for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
        ]
    )


def matches(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    radius: int = RADIUS,
) -> DataFrame:
    """(text_hash, item, similarity): for each text the items that a window of it repeats, with
    the largest similarity found. `text_hash` is xxhash64 of the text."""
    item = items.select(
        F.xxhash64(F.coalesce(F.col(item_id).cast("string"), F.lit("")), F.col(item_id).isNull(), F.col(item_text)).alias("item"),
        F.col(item_id).alias("item_id"),
        sequence(F.col(item_text), shingle_words).alias("s"),
    ).where(F.size("s") > 0).dropDuplicates(["item"])
    item = cut(item.withColumn("m", F.size("s")).withColumn("item_print", simhash(F.col("s"))), "decontam-items")
    at = item.select("item", "m", F.posexplode("s").alias("i", "h"))
    count = at.groupBy("item", "m", "h").agg(F.count(F.lit(1)).alias("in_item"), F.collect_list("i").alias("places"))
    texts = docs.select(F.col(text).alias("t")).where(F.col("t").isNotNull())
    every = texts.select(F.xxhash64("t").alias("text_hash"), F.posexplode(sequence(F.col("t"), shingle_words)).alias("p", "h"))
    # equal texts give equal rows: one of each stays
    hits = every.join(broadcast_if_small(count), "h").dropDuplicates(["text_hash", "item", "p"])
    hits = cut(hits.select("text_hash", "item", "m", "p", "h", "in_item", "places"), "decontam-hits")
    starts = hits.select("text_hash", "item", "m", "p", F.explode("places").alias("i"))
    starts = starts.select("text_hash", "item", "m", (F.col("p") - F.col("i")).alias("start"))
    starts = starts.withColumn("start", F.greatest("start", F.lit(0))).distinct()
    held = cut(hits.select("text_hash").distinct(), "decontam-texts")
    whole = texts.withColumn("text_hash", F.xxhash64("t")).join(held, "text_hash").dropDuplicates(["text_hash"])
    whole = whole.select("text_hash", sequence(F.col("t"), shingle_words).alias("all"))
    # items of any length stand in texts of at least one shingle: a window may be cut by the end
    windows = starts.join(whole, "text_hash").select(
        "text_hash", "item", "m", "start", F.slice("all", F.col("start") + 1, F.col("m")).alias("w")
    )
    windows = windows.select(
        "text_hash", "item", "m", "start", F.size("w").alias("size"), simhash(F.col("w")).alias("print")
    )
    left = windows.select("*", F.inline(blocks(F.col("print"), radius)))
    right = item.select("item", "item_print", F.inline(blocks(F.col("item_print"), radius)))
    near = left.join(broadcast_if_small(right), ["item", "block", "value"])
    near = near.where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
    near = cut(near.select("text_hash", "item", "m", "start", "size").distinct(), "decontam-near")
    # the shared weight of a window, from its hits: a window lies in two runs of m places
    run = near.withColumn("run", F.explode(F.array(F.floor(F.col("start") / F.col("m")), F.floor(F.col("start") / F.col("m")) + 1)))
    spots = hits.select("text_hash", "item", F.floor(F.col("p") / F.col("m")).alias("run"), "p", "h", "in_item")
    inside = run.join(spots, ["text_hash", "item", "run"]).where(
        (F.col("p") >= F.col("start")) & (F.col("p") < F.col("start") + F.col("m"))
    )
    key = ["text_hash", "item", "start", "m", "size"]
    weight = inside.groupBy(*key, "h", "in_item").agg(F.count(F.lit(1)).alias("in_window"))
    common = weight.groupBy(*key).agg(F.sum(F.least("in_item", "in_window")).alias("common"))
    exact = common.withColumn("total", F.col("m") + F.col("size") - F.col("common"))
    exact = exact.where(100 * F.col("common") >= percent * F.col("total"))
    best = exact.groupBy("text_hash", "item").agg(F.max(F.col("common") / F.col("total")).alias("similarity"))
    return best.join(broadcast_if_small(item.select("item", "item_id")), "item").select(
        "text_hash", "item_id", "similarity"
    )


def mark(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """`docs` plus contaminated, n_items and items (ascending ids of the repeated items)."""
    found = matches(docs, items, text, **options).groupBy("text_hash").agg(
        F.array_sort(F.collect_set("item_id")).alias("items")
    )
    found = cut(found, "decontam-found")
    h, ids = named(docs, ["text_hash", "found_items"])
    keyed = docs.withColumn(h, F.xxhash64(F.col(text)))
    found = broadcast_if_small(found.select(F.col("text_hash").alias(h), F.col("items").alias(ids)))
    out = keyed.join(found, h, "left").drop(h)
    values = {
        "contaminated": F.col(ids).isNotNull(),
        "n_items": F.coalesce(F.size(ids), F.lit(0)).cast("long"),
        "items": F.col(ids),
    }
    return out.withColumns(values).drop(ids)


def clean(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """Rows of `docs` that repeat no item."""
    flag, = named(docs, ["contaminated"])
    found = cut(matches(docs, items, text, **options).select("text_hash").distinct(), "decontam-found")
    keyed = docs.withColumn(flag, F.xxhash64(F.col(text)))
    found = broadcast_if_small(found.withColumnRenamed("text_hash", flag))
    return keyed.join(found, flag, "left_anti").select(*docs.columns)
