"""Content dedupe with a fixed time to live.

A hash is global over sites. Its life starts when a record with it is kept and does not slide: a
dropped repeat changes nothing, and at exactly `expires_at` the next record is kept again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill import fixed_values as V
from gristmill.session import broadcast_if_small, cut

HASH = "content_hash"
ORDER = ("started_at", "page_ord", "element_ord")
MICROS_PER_DAY = 86_400_000_000

# Distinct times of one hash that are folded in one row (80 kB as longs); longer chains are cut
# into slices of about as many times each.
FOLD_LIMIT = 10_000

# Rows of lists are folded in parts of about so many times, since each time gets its hash beside it.
PART_TIMES = 100_000


def first_per_key(records: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order.

    The rank filter is applied before the shuffle as well (`WindowGroupLimit`), so of a key with
    very many rows only one per input task travels.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return records.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def dedupe_batch(records: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Keep the first record per content hash, over all sites of the batch."""
    return first_per_key(records, [HASH], order)


def drop_seen(
    records: DataFrame, seen: DataFrame, *, now: str = "started_at", small_batch: bool = False
) -> DataFrame:
    """Drop records whose hash is still alive in `seen` at their own time `now`.

    Marks left by the same run do not count, so a repeated run gives the same result. With
    `small_batch` a counted broadcast of the batch's hashes filters the state first, so that a
    micro-batch does not shuffle a state table many times its size.
    """
    if small_batch:
        hashes = broadcast_if_small(records.select(HASH).distinct())
        seen = seen.join(hashes, HASH, "left_semi")
    r, s = records.alias("r"), seen.alias("s")
    alive = (
        (F.col(f"r.{HASH}") == F.col(f"s.{HASH}"))
        & (F.col(f"r.{now}") < F.col("s.expires_at"))
        & ~F.col("s.run_id").eqNullSafe(F.col("r.run_id"))
    )
    return r.join(s, alive, "left_anti")


def seen_rows(
    kept: DataFrame, *, now: str = "started_at", ttl_days: int = V.DEDUPE_TTL_DAYS
) -> DataFrame:
    """State rows for kept records."""
    return kept.select(
        HASH,
        "site_id",
        F.col(now).alias("first_seen"),
        (F.col(now) + F.expr(f"interval {ttl_days} days")).alias("expires_at"),
        "run_id",
    )


def mark_seen(seen: DataFrame, marked: DataFrame, *, alive_at: str | None = None) -> DataFrame:
    """`seen` with the rows of `marked` upserted; the latest mark of a hash wins.

    `alive_at` (a timestamp) also drops rows that have expired by then.
    """
    both = seen.withColumn("_new", F.lit(0)).unionByName(marked.withColumn("_new", F.lit(1)))
    if alive_at is not None:
        both = both.filter(F.col("expires_at") > F.lit(alive_at).cast("timestamp"))
    latest = [F.desc("first_seen"), F.desc("_new"), F.desc("run_id"), F.desc("site_id")]
    return first_per_key(both, [HASH], latest).drop("_new")


def dedupe_history(
    records: DataFrame,
    *,
    ttl_days: float = V.DEDUPE_TTL_DAYS,
    now: str = "started_at",
    order: Sequence[str] = ("page_ord", "element_ord"),
    seen: DataFrame | None = None,
    fold_limit: int = FOLD_LIMIT,
) -> DataFrame:
    """Dedupe many runs at once, as if they had run one after the other by `now`.

    Per hash the kept times form a chain: the first time, then the first time at or after its
    expiry, and so on. Chains are folded from one sorted list per hash; those of hashes with more than
    `fold_limit` distinct times are linked over time slices instead (`_link_chains`), so that no task
    holds them. Expects `records` to be a stored table, since it is read more than once.
    """
    if ttl_days <= 0:
        return records  # expires at once: nothing is ever a repeat
    ttl = int(ttl_days * MICROS_PER_DAY)
    records = records.withColumn("_at", F.unix_micros(now))
    times = records.select(HASH, "_at").distinct()
    free = None
    if seen is not None:
        alive = seen.groupBy(HASH).agg(F.max_by("expires_at", "first_seen").alias("expires_at"))
        free = alive.select(HASH, F.unix_micros("expires_at").alias("free_at"))

    long_chains = times.groupBy(HASH).count().filter(F.col("count") > fold_limit).select(HASH)
    if long_chains.isEmpty():
        kept = _fold_chains(times, free, ttl)
    else:
        long_chains = broadcast_if_small(cut(long_chains, "long-chains"))
        short = times.join(long_chains, HASH, "left_anti")
        long = times.join(long_chains, HASH, "left_semi")
        linked = _link_chains(long, free, ttl, fold_limit)
        kept = _fold_chains(short, free, ttl).unionByName(linked)

    # the rank and the join share one shuffle of the records
    firsts = first_per_key(records, [HASH, "_at"], order)
    return firsts.join(kept, [HASH, "_at"], "left_semi").drop("_at")


def _greedy(ats: np.ndarray, start: int, ttl: int) -> np.ndarray:
    """The chain in ascending `ats` from place `start` on: a search per kept time."""
    kept = []
    while start < len(ats):
        kept.append(start)
        start = int(np.searchsorted(ats, ats[start] + ttl))
    return ats[kept]


def _fold_chains(times: DataFrame, free: DataFrame | None, ttl: int) -> DataFrame:
    chains = times.groupBy(HASH).agg(F.sort_array(F.collect_list("_at")).alias("ats"))
    if free is not None:
        chains = chains.join(free, HASH, "left")
    else:
        chains = chains.withColumn("free_at", F.lit(None).cast("long"))
    return _folded(chains, ttl)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about `PART_TIMES` times in their lists, or one longer list."""
    for batch in batches:
        ends, start = batch.column("ats").offsets.to_numpy(), 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, int(ends[start]) + PART_TIMES, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def _lists(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The sorted times `ats` of each row."""
    lists = batch.column("ats")
    values, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    for k in range(batch.num_rows):
        yield values[ends[k] : ends[k + 1]]


def _each(hashes: pa.Array, lists: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """The values of one list per hash, with their hash beside each."""
    every = np.concatenate(lists) if lists else np.zeros(0, dtype=np.int64)
    of = pa.array(np.repeat(np.arange(len(lists)), [len(x) for x in lists]), pa.int64())
    return hashes.take(of), pa.array(every, pa.int64())


def _folded(chains: DataFrame, ttl: int) -> DataFrame:
    """(hash, _at) of the chain in each row's sorted `ats`, from the first time at or after `free_at` on."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            kept = []
            for ats, bound in zip(_lists(batch), batch.column("free_at").to_pylist(), strict=True):
                start = 0 if bound is None else int(np.searchsorted(ats, bound))
                kept.append(_greedy(ats, start, ttl))
            yield pa.RecordBatch.from_arrays([*_each(batch.column(HASH), kept)], names=[HASH, "_at"])

    return chains.mapInArrow(fold, f"{HASH} string, _at bigint")


def _exits(ats: np.ndarray, ttl: int) -> np.ndarray:
    """For each of ascending `ats`, where a chain through it leaves them: the expiry of its last time."""
    after = np.searchsorted(ats, ats + ttl).tolist()
    bound = (ats + ttl).tolist()
    for k in range(len(bound) - 1, -1, -1):
        if after[k] < len(bound):
            bound[k] = bound[after[k]]
    return np.array(bound, dtype=np.int64)


def _link_chains(times: DataFrame, free: DataFrame | None, ttl: int, slice_rows: int) -> DataFrame:
    """Chains of hashes with very many times, by slices of time and pointer doubling.

    Each slice, of about `slice_rows` times, finds for all its times where a chain through them leaves
    the slice. That bound is looked up in the slices behind it, which links times that enter slices.
    From the chain's start, links of doubled length then reach all entries in log2(slices) rounds, and
    every slice that is entered folds its own part. A slice is a task's memory; a round is one join
    of entries.
    """
    spans = times.groupBy(HASH).agg(
        F.min("_at").alias("lo"), (F.max("_at") - F.min("_at") + 1).alias("span"), F.count("*").alias("n")
    )
    # distinct times: a slice this wide holds `slice_rows` on the average
    width = F.greatest(F.lit(1), F.ceil(F.col("span") * (F.lit(float(slice_rows)) / F.col("n")))).cast("long")
    spans = cut(spans.select(HASH, "lo", width.alias("width")), "chain-spans")
    spans = broadcast_if_small(spans)

    # a row per slice, as slices may be very many and small
    sliced = times.join(spans, HASH).withColumn("slice", F.expr("(_at - lo) div width"))
    sliced = sliced.groupBy(HASH, "slice").agg(F.sort_array(F.collect_list("_at")).alias("ats"))
    sliced = cut(sliced, "chain-times")

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            lists = list(_lists(batch))
            hashes, ats = _each(batch.column(HASH), lists)
            bounds = _each(batch.column(HASH), [_exits(one, ttl) for one in lists])[1]
            yield pa.RecordBatch.from_arrays([hashes, ats, bounds], names=[HASH, "_at", "bound"])

    left = sliced.mapInArrow(leave, f"{HASH} string, _at bigint, bound bigint")
    left = cut(left, "chain-exits")
    starts = sliced.groupBy(HASH).agg(F.min(F.get("ats", F.lit(0))).alias("bound"))
    if free is not None:
        known = starts.join(free, HASH, "left")
        starts = known.select(HASH, F.greatest("bound", "free_at").alias("bound"))
    bounds = left.select(HASH, "bound").unionByName(starts).distinct()
    targets = cut(_first_at_or_after(bounds, sliced, spans), "chain-targets")

    links = left.join(targets, [HASH, "bound"]).select(HASH, "_at", F.col("target").alias("next"))
    links = links.join(targets.select(HASH, F.col("target").alias("_at")).distinct(), [HASH, "_at"], "left_semi")
    reached = starts.join(targets, [HASH, "bound"]).select(HASH, F.col("target").alias("_at"))
    links, reached = cut(links, "chain-links"), cut(reached, "chain-reached")
    while not links.isEmpty():
        further = reached.join(links, [HASH, "_at"]).select(HASH, F.col("next").alias("_at"))
        reached = cut(reached.unionByName(further).distinct(), "chain-reached")
        onward = links.select(HASH, F.col("_at").alias("next"), F.col("next").alias("beyond"))
        links = cut(links.join(onward, [HASH, "next"]).select(HASH, "_at", F.col("beyond").alias("next")), "chain-links")

    entries = reached.join(spans, HASH).select(
        HASH, F.expr("(_at - lo) div width").alias("slice"), F.col("_at").alias("free_at")
    )
    # a chain enters a slice once
    return _folded(sliced.join(entries, [HASH, "slice"]), ttl)


def _first_at_or_after(bounds: DataFrame, sliced: DataFrame, spans: DataFrame) -> DataFrame:
    """`bounds(hash, bound)` with `target`, the hash's first time at or after the bound, where there is
    one: in the bound's own slice, or else the first time of the next slice that has any."""
    placed = bounds.join(spans, HASH).select(HASH, F.expr("(bound - lo) div width").alias("slice"), "bound")
    both = placed.withColumn("_at", F.lit(None).cast("long")).unionByName(
        sliced.select(HASH, "slice", F.explode("ats").alias("_at")).withColumn("bound", F.lit(None).cast("long"))
    )
    place = F.coalesce("bound", "_at")
    # from the last time backwards, as frames that only grow take one pass
    onward = Window.partitionBy(HASH, "slice").orderBy(place.desc())
    onward = onward.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = both.withColumn("target", F.min("_at").over(onward)).where("bound IS NOT NULL")

    firsts = sliced.select(HASH, "slice", F.get("ats", F.lit(0)).alias("first"))
    asked = placed.select(HASH, "slice").distinct().withColumn("first", F.lit(None).cast("long"))
    behind = Window.partitionBy(HASH).orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    later = asked.unionByName(firsts).groupBy(HASH, "slice").agg(F.max("first").alias("first"))
    later = later.select(HASH, "slice", F.min("first").over(behind).alias("later"))
    found = inside.join(later, [HASH, "slice"])
    return found.select(HASH, "bound", F.coalesce("target", "later").alias("target")).where("target IS NOT NULL")
