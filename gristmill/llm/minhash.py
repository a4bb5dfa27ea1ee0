"""MinHash near-duplicates: one-permutation hashing, optimal densification, star-shaped candidates.

A document's set holds the 64-bit hashes of its distinct word shingles. Equal sets are one class,
known by its hash, so copies never meet in a bucket. One hash per shingle fills
`bins` minima; an empty bin takes the minimum of the first filled bin in its own seeded order of all
bins (optimal densification: each empty bin probes by its own order). Runs of `rows` bins are band
keys. In each bucket all members are paired with one centre, so a bucket gives as many candidate
pairs as it has members, and these are confirmed on the full sets. A bucket whose members then still lie in
several components is settled in bounded groups of sets: each member outside the bucket's largest
component is held against the bucket's sets in one array pass, and only pairs that join
components come out, fewer than members. They are confirmed on the full sets too. No link is lost to
the star. The array passes of a bucket grow with its members outside the largest component.

At a similarity of 0.85 a pair misses all 40 bands of 6 with a probability under 1e-8, at 0.8 under
1e-5. Pairs of equal small sets are classes and never miss.

Rows: null and empty texts have an empty set and link with nothing. A text with fewer words than a
shingle is one shingle. Rows with one id are one document: they share its component. Null ids
form single components with a null id. Extra columns are not carried along. No rows in, none out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.common import bind, bounded_batches, spread
from gristmill.llm.graph import components
from gristmill.llm.quality_rules import words
from gristmill.session import cut, drop

BINS = 240
ROWS = 6
# Hashes of shingles that a group of buckets, or a slice of a large bucket, holds on the average.
BLOCK = 500_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shingles(text: Column, n: int) -> Column:
    """Distinct hashes of the n-word shingles; the whole sequence if shorter; empty without words."""

    def of(w: Column) -> Column:
        many = F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - (n - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, n)]),
        )
        # the seed keeps a short sequence apart from a full shingle
        short = F.array(F.xxhash64(F.lit(n), F.array_join(w, " ")))
        none = F.array().cast("array<bigint>")
        return F.when(F.size(w) == 0, none).when(F.size(w) < n, short).otherwise(many)

    lowered = F.translate(text, UPPER, LOWER)
    return F.array_distinct(bind(words(lowered), of))


def probes(bins: int, seed: int) -> np.ndarray:
    """For each bin, its own order of all bins."""
    return np.argsort(np.random.default_rng(seed).random((bins, bins)), axis=1).astype(np.int32)


def signatures(values: np.ndarray, offsets: np.ndarray, bins: int, order: np.ndarray) -> np.ndarray:
    """One row of `bins` densified minima per set; every set must have an element."""
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    h = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    slot = doc * bins + ((h >> np.uint64(40)) % np.uint64(bins)).astype(np.int64)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    flat = np.full(n * bins, empty, dtype=np.uint64)
    np.minimum.at(flat, slot, h)
    sig = flat.reshape(n, bins)
    filled = sig != empty
    out = sig.copy()
    at_doc, at_bin = np.nonzero(~filled)
    for k in range(bins):
        if not len(at_doc):
            break
        source = order[at_bin, k]
        hit = filled[at_doc, source]
        out[at_doc[hit], at_bin[hit]] = sig[at_doc[hit], source[hit]]
        at_doc, at_bin = at_doc[~hit], at_bin[~hit]
    return out


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key per band; the band's number is part of it."""
    bands = sig.shape[1] // rows
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (sig.shape[0], 1))
    for r in range(rows):
        key = (key ^ sig[:, r : bands * rows : rows]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def class_key(s: Column) -> Column:
    """Tells different sets apart, whatever the order of their elements: size and two hashes."""
    zero = F.lit(0).cast("long")
    return F.struct(
        F.size(s).alias("n"),
        F.aggregate(s, zero, lambda a, x: a.bitwiseXOR(x)).alias("x"),
        F.aggregate(s, zero, lambda a, x: a.bitwiseXOR(F.xxhash64(F.lit(7), x))).alias("y"),
    )


def banded(
    docs: DataFrame, id_col: str, text: str, shingle_words: int, bins: int, rows: int, seed: int = 1
) -> DataFrame:
    """(doc_id, n, x, y, bands) of every row: the class of its set, and its band keys."""
    order = probes(bins, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes = np.asarray(part.column("n"))
                held = part.filter(pa.array(sizes > 0))
                keys = np.empty((0, bins // rows), dtype=np.int64)
                if held.num_rows:
                    s = held.column("s")
                    offsets = np.asarray(s.offsets)
                    values = np.asarray(s.values)[offsets[0] : offsets[-1]]
                    keys = band_keys(signatures(values, offsets - offsets[0], bins, order), rows)
                ends = np.concatenate([[0], np.cumsum((sizes > 0) * keys.shape[1])]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))
                columns = [part.column(c) for c in ("doc_id", "n", "x", "y")]
                yield pa.RecordBatch.from_arrays([*columns, bands], names=["doc_id", "n", "x", "y", "bands"])

    bounded_batches(docs.sparkSession)
    both = bind(
        shingles(F.col(text), shingle_words),
        lambda s: F.struct(class_key(s).alias("k"), s.alias("s")),
    )
    flat = docs.select(F.col(id_col).cast("long").alias("doc_id"), both.alias("o"))
    flat = flat.select("doc_id", "o.k.n", "o.k.x", "o.k.y", "o.s")
    return flat.mapInArrow(run, "doc_id long, n int, x long, y long, bands array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets meet 100 * intersection >= percent * union."""
    near = pairs.join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    near = near.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return near.where(100 * common >= percent * union).select("a", "b")


def _sized(percent: int) -> Column:
    """Sets of such different sizes cannot be similar enough."""
    small, large = F.least("na", "nb").cast("long"), F.greatest("na", "nb").cast("long")
    return (F.col("a") != F.col("b")) & (100 * small >= percent * large)


def _union(pairs: list[tuple[int, int]], labels: np.ndarray) -> None:
    """Relabel components that pairs of them join."""
    for x, y in pairs:
        labels[labels == y] = x


def open_links(
    ids: np.ndarray, label: np.ndarray, values: np.ndarray, offsets: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Pairs of ids of different components that may be linked, enough of them to join all that links join.

    The sets hold 32-bit hashes, so an intersection may be a little smaller than it looks. A pair that
    holds with a margin for that joins its components here, and one pair is enough for two
    components; any pair that holds only without the margin is given too.
    """
    n = np.diff(offsets)
    tokens = np.unique(values, return_inverse=True)[1]
    label = np.unique(label, return_inverse=True)[1]
    largest = np.bincount(label).argmax()
    held = np.zeros(tokens.max() + 1, dtype=np.int64)
    out = []
    # of two members of different components one is outside the largest
    for x in np.nonzero(label != largest)[0]:
        other = label != label[x]
        if not other.any():
            break
        mine = tokens[offsets[x] : offsets[x + 1]]
        held[mine] = 1
        common = np.add.reduceat(held[tokens], offsets[:-1])
        held[mine] = 0
        near = np.nonzero(other & (100 * common >= percent * (n[x] + n - common)))[0]
        if not len(near):
            continue
        # collisions expected in n * n tries, far exceeded
        sure = common[near] - 3 - (8 * n[x] * n[near].astype(float) / 2**32).astype(np.int64)
        sure = 100 * sure >= percent * (n[x] + n[near] - sure)
        joined, first = np.unique(label[near[sure]], return_index=True)
        out += [(ids[x], ids[y]) for y in near[~sure]] + [(ids[x], ids[y]) for y in near[sure][first]]
        _union([(label[x], y) for y in joined], label)
    return out


def settled(live: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that may join components within buckets; `live` is (bucket, id, n, c).

    Sets travel to their buckets as 32-bit hashes. Small buckets share a group of about BLOCK hashes. A
    larger bucket is dealt into slices by id, and every two slices meet in a group of their own, so
    a group is bounded however large a bucket is.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("bucket")
        bucket, ids, label = (np.asarray(table.column(c)) for c in ("bucket", "id", "c"))
        lists = table.column("s").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        offsets, values = np.asarray(lists.offsets).astype(np.int64), np.asarray(lists.values)
        ends = np.append(np.nonzero(np.diff(bucket))[0] + 1, len(bucket))
        out, at = [], 0
        for end in ends:
            if (label[at:end] != label[at]).any():
                low, high = offsets[at], offsets[end]
                out += open_links(ids[at:end], label[at:end], values[low:high], offsets[at : end + 1] - low, percent)
            at = end
        pairs = np.array(out, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pairs.min(axis=1, initial=2**63 - 1), "b": pairs.max(axis=1, initial=-(2**63))})

    about = live.groupBy("bucket").agg(
        F.sum("n").alias("total"), F.min("c").alias("c_lo"), F.max("c").alias("c_hi")
    )
    about = about.where("c_lo < c_hi").select(
        "bucket", "total", F.ceil(F.col("total") / BLOCK).cast("int").alias("slices")
    )
    about = cut(about, "minhash-open")
    packs = (about.where("slices = 1").agg(F.sum("total")).first()[0] or 0) // BLOCK + 1
    mine = F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")
    every = F.sequence(F.lit(0), F.col("slices") - 1)
    whole = F.col("slices") == 1
    dealt = live.join(about, "bucket").select(
        "bucket", "id", "c", mine.alias("mine"), whole.alias("whole"),
        F.explode(F.when(whole, F.array(F.lit(0))).otherwise(F.array_except(every, F.array(mine)))).alias("other"),
    )
    small = F.transform("s", lambda x: x.bitwiseAND(0xFFFFFFFF))
    # as signed 32-bit numbers
    small = F.transform(small, lambda x: F.when(x > 0x7FFFFFFF, x - 0x100000000).otherwise(x).cast("int"))
    dealt = dealt.join(sets.select("id", small.alias("s")), "id").select(
        F.when(F.col("whole"), F.pmod(F.xxhash64("bucket"), F.lit(packs))).otherwise(F.col("bucket")).alias("g"),
        F.when(F.col("whole"), -1).otherwise(F.least("mine", "other")).alias("i"),
        F.when(F.col("whole"), -1).otherwise(F.greatest("mine", "other")).alias("j"),
        "bucket", "id", "c", "s",
    )
    return dealt.groupBy("g", "i", "j").applyInArrow(run, "a long, b long").distinct()


def links(members: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Confirmed links (a, b), enough of them to connect all that any bucket's pairs connect.

    `members` is (bucket, id, n); `sets_of` gives the full sets (id, s) of the ids of a table.
    """
    centre = members.groupBy("bucket").agg(F.min(F.struct("id", "n")).alias("centre"), F.max("id").alias("hi"))
    centre = centre.where(F.col("centre.id") < F.col("hi")).select("bucket", "centre")
    shared = cut(members.join(centre, "bucket"), "minhash-shared")
    sets = cut(sets_of(shared.select("id").distinct()), "minhash-sets")
    pairs = shared.select(
        F.col("centre.id").alias("a"), F.col("centre.n").alias("na"), F.col("id").alias("b"), F.col("n").alias("nb")
    )
    pairs = pairs.where(_sized(percent)).select("a", "b").distinct()
    star = cut(_verified(pairs, sets, percent), "minhash-star")
    label = components(star).withColumnRenamed("component", "c")
    live = shared.select("bucket", "id", "n").join(label, "id", "left").withColumn("c", F.coalesce("c", "id"))
    live = cut(live, "minhash-live")
    drop(shared)
    rest = cut(_verified(settled(live, sets, percent), sets, percent), "minhash-links")
    drop(live, sets)
    return star.unionByName(rest)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    bins: int = BINS,
    rows: int = ROWS,
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links) and kept, per row."""
    bands = cut(banded(spread(docs), id_col, text, shingle_words, bins, rows), "minhash-bands")
    every = bands.withColumn("id", F.xxhash64("n", "x", "y"))
    real = every.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).select("doc_id", "id", "n", "bands")
    # a class is known by its hash, and its set is read from the row of its smallest document
    classes = cut(real.groupBy("id").agg(F.min("doc_id").alias("lo")), "minhash-classes")
    lead = real.join(classes, "id").where(F.col("doc_id") == F.col("lo")).dropDuplicates(["id"])
    members = cut(lead.select(F.explode("bands").alias("bucket"), "id", "n"), "minhash-members")

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = classes.join(ids, "id").select("id", F.col("lo").alias("doc"))
        rows_of = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text).alias("t"))
        rows_of = rows_of.join(wanted.select("doc").distinct(), "doc")
        made = bind(shingles(F.col("t"), shingle_words), lambda s: F.struct(class_key(s).alias("k"), s.alias("s")))
        made = rows_of.select(made.alias("o")).select(F.xxhash64("o.k.n", "o.k.x", "o.k.y").alias("id"), "o.s")
        return made.join(wanted.select("id"), "id", "left_semi").dropDuplicates(["id"])

    found = links(members, sets_of, percent)
    drop(members)
    # an id may stand on several rows; then it links its classes
    pairs = real.select("doc_id", "id").distinct()
    several = pairs.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("hi")).where("a < hi")
    same = pairs.join(several, "doc_id").where(F.col("id") != F.col("a")).select("a", F.col("id").alias("b"))
    label = components(found.unionByName(same)).withColumnRenamed("component", "c")
    label = classes.join(label, "id", "left").select("id", "lo", F.coalesce("c", "id").alias("c"))
    label = cut(label, "minhash-labels")
    low = label.groupBy("c").agg(F.min("lo").alias("low"))
    moved = label.join(low, "c").select("id", "low")
    of_id = pairs.join(moved, "id").groupBy("doc_id").agg(F.min("low").alias("low"))
    out = (
        every.select("doc_id", F.col("n").cast("long").alias("n_shingles"))
        .join(of_id, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("low", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
    out = cut(out, "minhash-result")
    drop(bands, classes, label)
    return out
