"""Runs of repeating words, found by recompression and grammar LCE queries.

The words of an Arrow batch stand in one sequence of numbers, each document between signs that occur
once. Two steps find every run with at least `min_periods` (3 or more) of its smallest period q:

1. Harmonic grid: such a run holds, for some multiple i of q, two equal blocks i..i+q and i+q..i+2q.
   For every q the multiples of q whose blocks agree in three words are candidates, n ln n places
   in all, compared column-wise.
2. Recompression: the sequences with candidates become a run-length grammar. Rounds alternate:
   block compression gives every maximal repetition of one sign a new sign, pair compression joins
   every sign of a drawn left class with a following one of the right class. Equal stretches are
   compressed alike but at their ends, so a query for the longest common extension climbs both
   places while they agree, compares at most three signs a level, and comes down again to the first
   difference. Extensions to both sides of a candidate give the run exactly. All candidates are
   answered together, level by level.

Of equal stretches the smallest period is kept: it is the stretch's own, as it divides the others.
The classes are drawn from a fixed seed, and results do not depend on them. Work is that of a
sequence's n ln n comparisons; memory is in proportion to the batch, or to its one longest text.

Rows: a null or empty text has no words and no runs; its collapsed text is empty. Each row is
treated by itself, repeated rows alike. Extra columns are carried along; result columns replace
columns of the same name (compared without case). No rows in, none out.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from gristmill.llm.common import bounded_batches, spread

# Candidates that are answered together.
TOGETHER = 1 << 19

RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])


class Level(NamedTuple):
    """One sequence of the grammar, and how it is compressed to the next one."""

    signs: np.ndarray
    parent: np.ndarray  # place in the next sequence, by place
    first: np.ndarray  # first place here, by place in the next sequence, and the end
    blocks: bool

    def mirrored(self) -> Level:
        up = len(self.first) - 1
        return Level(
            self.signs[::-1], up - 1 - self.parent[::-1], len(self.signs) - self.first[::-1], self.blocks
        )

    def step(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Signs that are known to agree from places x and y, whose signs are equal."""
        if not self.blocks:
            return np.ones(len(x), dtype=np.int64)
        return np.minimum(self.first[self.parent[x] + 1] - x, self.first[self.parent[y] + 1] - y)


def _level(signs: np.ndarray, starts: np.ndarray, code: np.ndarray, blocks: bool) -> tuple[Level, np.ndarray]:
    first = np.flatnonzero(starts)
    parent = np.cumsum(starts) - 1
    _, names = np.unique(code, return_inverse=True)
    return Level(signs, parent, np.append(first, len(signs)), blocks), names


def grammar(signs: np.ndarray, seed: int = 7) -> list[Level]:
    """The levels of the run-length grammar of a sequence, from the sequence itself upwards."""
    draw = np.random.default_rng(seed)
    levels = []
    while len(signs) > 1:
        fresh = np.append(True, signs[1:] != signs[:-1])
        if not fresh.all():
            first = np.flatnonzero(fresh)
            sizes = np.diff(np.append(first, len(signs)))
            level, signs_up = _level(signs, fresh, signs[first] * (sizes.max() + 1) + sizes, True)
            levels.append(level)
            signs = signs_up
            continue
        most = int(signs.max()) + 1
        left = draw.random(most) < 0.5
        before, after = left[signs[:-1]], left[signs[1:]]
        one, other = before & ~after, ~before & after
        joined = one if one.sum() >= other.sum() else other
        if not joined.any():
            continue
        second = np.append(False, joined)
        code = signs + np.append(joined * (signs[1:] + 1), 0) * most
        level, signs_up = _level(signs, ~second, code[~second], False)
        levels.append(level)
        signs = signs_up
    return levels


def common_extension(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many signs agree from place i and from place j on, for arrays of different places.

    The sequence must end in a sign that occurs once.
    """
    x, y = i.copy(), j.copy()
    stopped = np.full(len(x), -1)
    climbing = np.arange(len(x))
    for k, level in enumerate(levels):
        at = climbing
        inside = np.ones(len(at), dtype=bool)
        while True:
            a, b = x[at], y[at]
            inside = (level.first[level.parent[a]] != a) | (level.first[level.parent[b]] != b)
            at, a, b = at[inside], a[inside], b[inside]
            if not len(at):
                break
            equal = level.signs[a] == level.signs[b]
            stopped[at[~equal]] = k
            at, a, b = at[equal], a[equal], b[equal]
            n = level.step(a, b)
            x[at], y[at] = a + n, b + n
        climbing = climbing[stopped[climbing] < 0]
        x[climbing], y[climbing] = level.parent[x[climbing]], level.parent[y[climbing]]
    for k in range(len(levels) - 2, -1, -1):
        level = levels[k]
        at = np.flatnonzero(stopped > k)
        x[at], y[at] = level.first[x[at]], level.first[y[at]]
        while len(at):
            a, b = x[at], y[at]
            equal = level.signs[a] == level.signs[b]
            at, a, b = at[equal], a[equal], b[equal]
            n = level.step(a, b)
            x[at], y[at] = a + n, b + n
    return x - i


def _agree(signs: np.ndarray, i: np.ndarray, q: np.ndarray | int) -> np.ndarray:
    """Do the blocks of q signs from i and from i + q agree in their first, middle and last sign?"""
    ok = signs[i] == signs[i + q]
    for shift in (q - 1, q // 2):
        at = np.flatnonzero(ok)
        part = q if isinstance(q, int) else q[at]
        move = shift if isinstance(shift, int) else shift[at]
        ok[at] = signs[i[at] + move] == signs[i[at] + move + part]
    return ok


def candidates(signs: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i, multiples of a period q up to `longest`, whose blocks of q agree in three signs; in
    parts. About two square roots of the length are the steps it takes."""
    n = len(signs)
    turn = min(longest, int(n**0.5))
    for q in range(1, turn + 1):
        i = np.arange(0, n - 2 * q + 1, q)
        i = i[_agree(signs, i, q)]
        if len(i):
            yield i, np.full(len(i), q)
    k = 0
    while turn < longest and (k + 2) * (turn + 1) <= n:
        q = np.arange(turn + 1, min(longest, n // (k + 2)) + 1)
        q = q[_agree(signs, k * q, q)]
        if len(q):
            yield k * q, q
        k += 1


def _gathered(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= TOGETHER:
            yield np.concatenate([p[0] for p in held]), np.concatenate([p[1] for p in held])
            held, size = [], 0
    if held:
        yield np.concatenate([p[0] for p in held]), np.concatenate([p[1] for p in held])


def _smallest(found: np.ndarray) -> np.ndarray:
    """Rows (start, end, period): of equal stretches that with the smallest period."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.append(True, (found[1:, :2] != found[:-1, :2]).any(axis=1)) if len(found) else np.zeros(0, bool)
    return found[new]


def runs(texts: list[np.ndarray], min_words: int = 24, min_periods: int = 3) -> list[np.ndarray]:
    """Of each sequence of numbers (0 or more) its runs, rows (start, length, period) by start, then
    period."""
    if min_periods < 3:
        raise ValueError("the grid finds runs of three periods and more")
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    out = [np.zeros((0, 3), dtype=np.int64)] * len(texts)
    if not len(texts) or sizes.max() < max(min_words, min_periods):
        return out

    def joined(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts end to end between signs that occur once, and the place of each text's start."""
        lowest = 1 + max((int(t.max()) for t in texts if len(t)), default=0)
        begins = np.cumsum(np.append(1, sizes[which] + 1))
        signs = np.arange(lowest, lowest + begins[-1])
        for k, b in zip(which, begins, strict=False):
            signs[b : b + sizes[k]] = texts[k]
        return signs, begins

    signs, begins = joined(np.arange(len(texts)))
    longest = int(sizes.max()) // min_periods
    hit = np.zeros(len(texts), dtype=bool)
    for i, q in candidates(signs, longest):
        text = np.searchsorted(begins, i, side="right") - 1
        inside = (text >= 0) & (i + 2 * q < begins[text + 1])
        hit[text[inside]] = True
    which = np.flatnonzero(hit)
    if not len(which):
        return out
    signs, begins = joined(which)
    _, signs = np.unique(signs, return_inverse=True)
    levels = grammar(signs)
    backwards = [level.mirrored() for level in levels]
    found = np.zeros((0, 3), dtype=np.int64)
    for i, q in _gathered(candidates(signs, int(sizes[which].max()) // min_periods)):
        forward = common_extension(levels, i, i + q)
        keep = forward >= q
        i, q, forward = i[keep], q[keep], forward[keep]
        # nothing agrees before the first sign, which occurs once
        back = common_extension(backwards, len(signs) - i, len(signs) - i - q) if len(i) else i
        start, end = i - back, i + q + forward
        enough = end - start >= np.maximum(min_words, min_periods * q)
        found = _smallest(np.concatenate([found, np.stack([start, end, q], axis=1)[enough]]))
    text = np.searchsorted(begins, found[:, 0], side="right") - 1
    for k in np.unique(text):
        own = found[text == k]
        own = np.stack([own[:, 0] - begins[k], own[:, 1] - own[:, 0], own[:, 2]], axis=1)
        out[which[k]] = own[np.lexsort((own[:, 2], own[:, 0]))]
    return out


def find_runs(docs: DataFrame, text: str = "text", min_words: int = 24, min_periods: int = 3) -> DataFrame:
    """`docs` plus runs (start, length and period in words, by start, then period) and collapsed, the
    words that no run holds after its first period, joined by one space. Words are what is between
    ASCII spaces. A run has at least `min_words` words and `min_periods` of its smallest period, and
    no word next to it continues that period."""
    fields = [StructField("runs", ArrayType(RUN, False)), StructField("collapsed", StringType())]
    new = {f.name for f in fields}
    keep = [c for c in docs.columns if c.lower() not in new]
    schema = StructType([f for f in docs.schema.fields if f.name in keep] + fields)
    kind = pa.list_(pa.field("element", pa.struct([(c, pa.int64()) for c in RUN.names]), nullable=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # on bytes, split() knows ASCII spaces only
            words = [(v.as_py() or "").encode("utf-8").split() for v in batch.column(text)]
            numbers: dict[bytes, int] = defaultdict(count().__next__)
            found = runs(
                [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words],
                min_words, min_periods,
            )
            collapsed = []
            for w, own in zip(words, found, strict=True):
                if len(own):
                    gone = np.zeros(len(w) + 1, dtype=np.int64)
                    np.add.at(gone, own[:, 0] + own[:, 2], 1)
                    np.add.at(gone, own[:, 0] + own[:, 1], -1)
                    w = [w[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
                collapsed.append(b" ".join(w).decode("utf-8"))
            listed = [[dict(zip(RUN.names, r, strict=True)) for r in own.tolist()] for own in found]
            arrays = [batch.column(c) for c in keep]
            arrays += [pa.array(listed, kind), pa.array(collapsed, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=keep + [f.name for f in fields])

    bounded_batches(docs.sparkSession)
    return spread(docs).mapInArrow(run, schema)
