"""Removal of long byte strings that an earlier document holds too.

The dealt method merges shard Burrows-Wheeler transforms by refining their interleave. Each
refinement orders all suffixes by one byte more and moves a row per byte of text, so 50-byte strings
need 50 shuffles of the whole corpus. This module therefore finds the same strings by anchors (see
the README), and compares them exactly as far as 128-bit hashes are exact:

1. Every window of `length` bytes contains the smallest of its hashed 16-byte grams; equal windows
   have equal ones. These grams are the anchors, about one for every 18 bytes.
2. Anchors whose gram stands in one document only are left out.
3. An anchor's context is all bytes that windows around it can reach. Where an earlier document has
   the same whole context, all its windows are repeats.
4. Only the first document of each context goes on, where its gram has several contexts. These are dealt
   by gram, and a task compares the windows of many grams at once (`repeated`), which finds the repeats that
   begin or end inside a context. All windows of a context hold its anchor, so what repeats of it is one run.
5. Contexts of a gram with more than `CROWD` of them would be too much for a task. Windows that begin far
   ahead of the anchor share the bytes up to its gram's end, the others those from its gram on: a side
   that stands in one document only is left out with its windows. The windows of the other sides are rows
   and compared one by one (`_crowded`).

Each step is a job of its own that drops its shuffle files, and work tables go once they were read.

Rows: null texts are empty. A null id counts as later than any other id. Rows with one id do not
remove each other's bytes; repeated rows have equal results. Extra columns are not carried along. No
rows in, none out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm.common import bounded_batches, spread
from gristmill.session import cut, drop

LENGTH = 50
GRAM = 16
LAST = (1 << 63) - 1
# Bytes of short texts that are hashed together.
CHUNK = 1 << 18
# Contexts of a gram that one task compares (124 bytes each), and about how many of all grams it compares at once.
CROWD = 50_000
PART_CONTEXTS = 1 << 15
# Rounds in which windows of crowds are compared, each of its share of the hashes: a round's shuffle is on disk at a time.
ROUNDS = 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def _words(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as a number, zeros behind the end."""
    padded = np.concatenate([raw, np.zeros(8, dtype=np.uint8)])
    return np.ndarray(len(raw), dtype="<u8", buffer=padded, strides=(1,))


def _run(words: np.ndarray, at: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hashes of `size` bytes, eight at least, from each place."""
    value = np.full(len(at), 2 * size + (seed << 32), dtype=np.uint64)
    for k in range(0, size - 7, 8):
        value = _mix(value ^ words[at + k])
    return _mix(value ^ words[at + size - 8]) if size % 8 else value


def _cropped(raw: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, size: int) -> np.ndarray:
    """Hashes of `size` bytes from each place, as far as they lie from `low` to `high`, and of where these are."""
    place = at[:, None] + np.arange(-(-size // 8) * 8)
    inside = (place >= low[:, None]) & (place < np.minimum(high, at + size)[:, None])
    taken = np.where(inside, raw[np.clip(place, 0, len(raw) - 1)], np.uint8(0)).view("<u8")
    value = np.maximum(low - at, 0).astype(np.uint64) << np.uint64(32) | np.minimum(high - at, size).astype(np.uint64)
    for column in taken.T:
        value = _mix(value ^ column)
    return value


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """`pick` (minimum or maximum) over each run of `width` values."""
    size = 1
    while 2 * size <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def anchors(raw: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places, texts, gram hashes and context hashes of the anchors of texts that lie end to end."""
    n, width = len(raw), length - GRAM + 1
    if n < length:
        none = np.empty(0, dtype=np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64)
    words = _words(raw)
    eight = _mix(words[: n - 7])
    gram = _mix(eight[:-8] ^ words[8 : n - 7]) | np.uint64(1)
    low = _slide(gram, width, np.minimum)
    starts = np.concatenate([[0], ends[:-1]])
    text = np.repeat(np.arange(len(ends)), ends - starts)
    # no window crosses from text to text
    low = np.where(np.arange(length, n + 1) <= ends[text[: n - length + 1]], low, np.uint64(0))
    pad = np.zeros(width - 1, dtype=np.uint64)
    high = _slide(np.concatenate([pad, low, pad]), width, np.maximum)
    at = np.flatnonzero(gram == high)
    text = text[at]
    before, size = width - 1, 2 * length - GRAM
    context = np.zeros(len(at), dtype=np.uint64)
    whole = (at - before >= starts[text]) & (at - before + size <= ends[text])
    context[whole] = _run(words, at[whole] - before, size, 1)
    edge = ~whole
    context[edge] = _cropped(raw, at[edge] - before, starts[text[edge]], ends[text[edge]], size)
    return at, text, gram[at], context


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, end to end, and where each text ends."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


@contextmanager
def _lean(spark: SparkSession) -> Iterator[None]:
    """Jobs within drop their shuffle files when they end, and need not sort rows that they join with few."""
    within = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    }
    before = {key: spark.conf.get(key) for key in within}
    try:
        for key, value in within.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _bytes(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer((value.as_py() or "").encode("utf-8"), dtype=np.uint8)


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    t, own = F.coalesce(F.col(text), F.lit("")), F.col(id_col).cast("long")
    whole = F.xxhash64(t)
    return docs.select(
        own.alias("id"),
        F.coalesce(own, F.lit(LAST)).alias("doc"),
        # tells the rows of one id apart; without an id there may be very many
        F.when(own.isNull(), whole).otherwise(whole.bitwiseAND(F.lit(0xFFFFFFFF)).cast("long")).alias("print"),
        t.alias("text"),
    )


def covered(docs: DataFrame, length: int) -> list[DataFrame]:
    """(doc, print, a, b): byte runs of `docs` (doc, print, text) that earlier documents hold, as several tables."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, stamps = (batch.column(c).to_numpy() for c in ("doc", "print"))
            raw, ends = _texts(batch.column("text"))
            row, done = 0, 0
            while row < len(ends):
                stop = max(row + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
                at, text, gram, context = anchors(raw[done : ends[stop - 1]], ends[row:stop] - done, length)
                place = at - np.concatenate([[0], ends[row:stop] - done])[text]
                # very long texts go out in parts
                for k in range(0, len(at), 50_000):
                    part = slice(k, k + 50_000)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(gram[part].view(np.int64)), pa.array(context[part].view(np.int64)),
                            pa.array(ids[row + text[part]]), pa.array(stamps[row + text[part]]),
                            pa.array(place[part].astype(np.int32)),
                        ],
                        names=["gram", "context", "doc", "print", "p"],
                    )
                row, done = stop, int(ends[stop - 1])

    found = spread(docs).mapInArrow(mark, "gram long, context long, doc long, print long, p int")
    low = found.groupBy("gram").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
    shared = cut(low.where(F.col("lo") < F.col("hi")).select("gram"), "substring-grams")
    kept = cut(found.join(shared, "gram"), "substring-anchors")
    drop(shared)
    first = kept.groupBy("gram", "context").agg(F.min("doc").alias("lo"))
    first = cut(first, "substring-contexts")
    reach = length - GRAM
    both = kept.join(first, ["gram", "context"])
    whole = both.where(F.col("lo") < F.col("doc")).select(
        "doc", "print", F.greatest(F.col("p") - reach, F.lit(0)).alias("a"), (F.col("p") + length).alias("b")
    )
    whole = cut(whole, "substring-whole")
    open_ = cut(both.where(F.col("lo") == F.col("doc")).drop("lo"), "substring-open")
    drop(kept, first)
    several = open_.groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"), F.min("context").alias("c"), F.max("context").alias("d")
    )
    several = open_.join(several.where("c < d").select("gram", "n"), "gram")
    crowd = F.col("n") > CROWD
    places = several.groupBy("doc", "print").agg(
        F.collect_list(F.when(~crowd, F.col("p"))).alias("ps"), F.collect_list(F.when(crowd, F.col("p"))).alias("crowded")
    )
    places = cut(places, "substring-places")
    drop(open_)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = _texts(batch.column("text"))
            ps = batch.column("ps")
            row = np.repeat(np.arange(batch.num_rows), ps.value_lengths().to_numpy())
            p = ps.flatten().to_numpy().astype(np.int64)
            at = p + np.concatenate([[0], ends[:-1]])[row]
            words = _words(raw)
            gram = _mix(_mix(words[at]) ^ words[at + 8]) | np.uint64(1)
            room = np.minimum(ends[row] - at - GRAM, reach)
            padded = np.concatenate([np.zeros(reach, dtype=np.uint8), raw, np.zeros(length, dtype=np.uint8)])
            pieces = np.lib.stride_tricks.sliding_window_view(padded, reach + length)
            ids, stamps = (batch.column(c).to_numpy()[row] for c in ("doc", "print"))
            for k in range(0, len(at), 10_000):
                part = slice(k, k + 10_000)
                taken = pieces[at[part]]
                offsets = np.arange(len(taken) + 1, dtype=np.int32) * (reach + length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram[part].view(np.int64)), pa.array(ids[part]), pa.array(stamps[part]),
                        pa.array(p[part].astype(np.int32)), pa.array(room[part].astype(np.int32)),
                        pa.Array.from_buffers(pa.binary(), len(taken), [None, pa.py_buffer(offsets), pa.py_buffer(taken)]),
                    ],
                    names=["gram", "doc", "print", "p", "room", "piece"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, enough = [], 0, PART_CONTEXTS
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < enough:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            grams = rows.column("gram").to_numpy()
            # the last gram's contexts may go on in the next batch
            done = int(np.searchsorted(grams, grams[-1]))
            if done:
                yield repeated(rows.slice(0, done), length)
            held, n = rows.slice(done).to_batches(), n - done
            enough = max(PART_CONTEXTS, 2 * n)
        if n:
            yield repeated(pa.Table.from_batches(held), length)

    texts = docs.join(places, ["doc", "print"])
    found = texts.where(F.size("ps") > 0).select("doc", "print", "text", "ps")
    found = found.mapInArrow(around, "gram long, doc long, print long, p int, room int, piece binary")
    found = found.repartition("gram").sortWithinPartitions("gram")
    out = [whole, cut(found.mapInArrow(compare, "doc long, print long, a int, b int"), "substring-inside")]
    texts = texts.where(F.size("crowded") > 0).select("doc", "print", "text", F.col("crowded").alias("ps"))
    if not places.where(F.size("crowded") > 0).isEmpty():
        out += _crowded(texts, length)
    drop(places)
    return out


def repeated(rows: pa.Table, length: int) -> pa.RecordBatch:
    """(doc, print, a, b): what repeats of contexts (gram, doc, print, p, room, piece), all those of a gram among
    them; `room` is how many bytes the text has behind the gram, `piece` the bytes around it."""
    gram, doc, p, room = (rows.column(c).to_numpy() for c in ("gram", "doc", "p", "room"))
    raw = _texts(rows.column("piece").combine_chunks())[0]
    words, reach = _words(raw), length - GRAM
    at = np.arange(len(doc)) * (reach + length) + reach
    most, least = np.full(len(doc), -1), np.zeros(len(doc), dtype=np.int64)
    for ahead in range(reach, -1, -1):
        own = np.flatnonzero((p >= ahead) & (room >= reach - ahead))
        if not len(own):
            continue
        window = _run(words, at[own] - ahead, length, 1)
        order = np.argsort(window)
        window, own = window[order], own[order]
        new = np.ones(len(own), dtype=bool)
        new[1:] = (window[1:] != window[:-1]) | (gram[own[1:]] != gram[own[:-1]])
        begin = np.flatnonzero(new)
        low = np.minimum.reduceat(doc[own], begin)
        hit = own[doc[own] > np.repeat(low, np.diff(begin, append=len(own)))]
        most[hit] = np.maximum(most[hit], ahead)
        least[hit] = ahead
    hit = np.flatnonzero(most >= 0)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc[hit]), pa.array(rows.column("print").to_numpy()[hit]),
            pa.array((p[hit] - most[hit]).astype(np.int32)), pa.array((p[hit] - least[hit] + length).astype(np.int32)),
        ],
        names=["doc", "print", "a", "b"],
    )


def _crowded(texts: DataFrame, length: int) -> list[DataFrame]:
    """What repeats of the contexts at the places `ps` of `texts` (doc, print, text, ps), window by window."""
    reach, half = length - GRAM, (length - GRAM) // 2

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, stamp, value, ps in zip(*(batch.column(c) for c in ("doc", "print", "text", "ps"))):
                raw = _bytes(value)
                words, last, p = _words(raw), len(raw) - length, np.asarray(ps.values).astype(np.int64)
                right, left = p[p - half <= last], p[p >= half]
                key = [_run(words, right, length - half, 1), _run(words, left - half, GRAM + half, 2)]
                a = np.maximum(np.concatenate([right - half, left - reach]), 0)
                b = np.minimum(np.concatenate([right, left - half]), last)
                key = np.concatenate(key)[a <= b]
                a, b = a[a <= b], b[a <= b]
                for k in range(0, len(a), 50_000):
                    part = slice(k, k + 50_000)
                    m = len(a[part])
                    pieces = [raw[x:y].tobytes() for x, y in zip(a[part].tolist(), (b[part] + length).tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key[part].view(np.int64)),
                            pa.array(np.full(m, doc.as_py())), pa.array(np.full(m, stamp.as_py())),
                            pa.array(a[part].astype(np.int32)), pa.array(pieces, pa.binary()),
                        ],
                        names=["side", "doc", "print", "a", "piece"],
                    )

    found = cut(texts.mapInArrow(sides, "side long, doc long, print long, a int, piece binary"), "substring-sides")
    low = found.groupBy("side").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
    near = found.join(low.where(F.col("lo") < F.col("hi")).select("side"), "side")
    near = near.groupBy("doc", "print").agg(F.sort_array(F.collect_set(F.struct("a", "piece"))).alias("pieces"))
    near = cut(near, "substring-pieces")
    drop(found)

    def windows(rest: int) -> DataFrame:
        """The windows in the pieces, each place once, of those whose hash leaves `rest` divided by `ROUNDS`."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for doc, stamp, pieces in zip(*(batch.column(c) for c in ("doc", "print", "pieces"))):
                    begin, piece = pieces.values.flatten()
                    raw, ends = _texts(piece)
                    a, words = np.asarray(begin).astype(np.int64), _words(raw)
                    behind = a + np.diff(ends, prepend=0) - length + 1
                    # pieces overlap: each begins where those before it end
                    free = np.maximum(a, np.concatenate([[0], np.maximum.accumulate(behind)[:-1]]))
                    count = np.maximum(behind - free, 0)
                    offset = np.concatenate([[0], ends[:-1]]) - a
                    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    start = np.repeat(free, count) + step
                    at = start + np.repeat(offset, count)
                    for k in range(0, len(at), 50_000):
                        w = _run(words, at[k : k + 50_000], length, 1)
                        own = np.flatnonzero(w % np.uint64(ROUNDS) == rest)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(w[own].view(np.int64)),
                                pa.array(_run(words, at[k + own], length, 2).view(np.int64)),
                                pa.array(np.full(len(own), doc.as_py())), pa.array(np.full(len(own), stamp.as_py())),
                                pa.array(start[k + own].astype(np.int32)),
                            ],
                            names=["w", "g", "doc", "print", "s"],
                        )

        return near.mapInArrow(run, "w long, g long, doc long, print long, s int")

    out = []
    for rest in range(ROUNDS):
        single = windows(rest)
        lowest = single.groupBy("w", "g").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi")
        lowest = cut(lowest.select("w", "g", "lo"), "substring-lowest")
        repeat = single.join(lowest, ["w", "g"]).where(F.col("lo") < F.col("doc"))
        parts = repeat.select("doc", "print", F.col("s").alias("a"), (F.col("s") + length).alias("b"))
        out.append(cut(parts, "substring-parts"))
        drop(lowest)
    drop(near)
    return out


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, with_kept: bool = False
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row; kept bytes where asked for."""
    bounded_batches(docs.sparkSession)
    rows = _keyed(docs, id_col, text)
    with _lean(docs.sparkSession):
        parts = covered(rows, length)
        runs = reduce(DataFrame.unionByName, parts).groupBy("doc", "print")
        runs = cut(runs.agg(F.collect_set(F.struct("a", "b")).alias("runs")), "substring-runs")
        drop(*parts)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, value, found in zip(*(batch.column(c) for c in ("id", "text", "runs"))):
                raw = _bytes(value)
                change = np.zeros(len(raw) + 1, dtype=np.int32)
                if found.is_valid and len(found):
                    ends = found.values.flatten()
                    np.add.at(change, np.asarray(ends[0]), 1)
                    np.add.at(change, np.minimum(np.asarray(ends[1]), len(raw)), -1)
                gone = np.cumsum(change[:-1]) > 0
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (gone[:1].sum()))
                left = raw[~gone].tobytes()
                row = [doc.as_py(), len(raw), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()]
                out.append(row + [left] * with_kept)
            kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_kept
            names = schema.replace(",", "").split()[::2] + ["kept"] * with_kept
            columns = list(zip(*out, strict=True)) or [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    joined = rows.join(runs, ["doc", "print"], "left").select("id", "text", "runs")
    return joined.mapInArrow(apply, schema + (", kept binary" if with_kept else ""))
