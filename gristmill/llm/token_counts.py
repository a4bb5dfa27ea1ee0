"""Token counts by a table of frequent pre-tokens and a cache of the others.

The tokenizer is a sentencepiece BPE model without normalization. None of its pieces has the space
sign after another sign, or a line feed at all, so no merge crosses the places where a text is cut
here: before a run of spaces, and around every line feed. The tokens of a text are then the sum over
its pre-tokens, and a pre-token has the same count wherever it stands.

1. A bounded sketch (`approx_top_k`) over all rows finds the most frequent pre-tokens. Only sketches
   travel, first to `MERGERS` tasks and from there to one. No pre-token is a shuffle key.
2. Their counts, at most `FREQUENT` of at most `SIGNS` characters each (2.5 MB), are broadcast as one
   packed table. A worker unpacks it once.
3. Each task sums the counts of its texts from that table. What the table lacks is encoded, once per
   Arrow batch, and kept in the worker's cache, which starts anew before it would pass `CACHE` entries.
   The result does not depend on the table, the sketch's errors or the cache.

Rows: a null text is the empty text, with no bytes and no tokens. Repeated rows are counted one by
one. Extra columns are carried along; result columns replace columns of the same name (compared
without case). No rows in, none out.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from gristmill.llm.common import bounded_batches, named, spread, worker_state

SPACE = "▁"
# A run of spaces with what follows it up to the next one, or a line feed with the like.
PRE_TOKEN = re.compile(f"\n[^{SPACE}\n]*|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
FREQUENT = 16_384
SIGNS = 32
MERGERS = 64
TRACKED = 16_384
CACHE = 1_000_000
OVER = 4096


def pre_tokens(text: str) -> list[str]:
    """The pieces of a text that are encoded apart; joined, they are the text as the model sees it.

    A piece's one leading space sign is left out, as most pieces have it.
    """
    if not text:
        return []
    if SPACE not in text and text[0] != " " and "  " not in text:
        return text.replace("\n", " \n").split(" ")
    found = PRE_TOKEN.findall(SPACE + text.replace(" ", SPACE))
    return [p[1:] if p[0] == SPACE else p for p in found]


def whole(pre_token: str) -> str:
    """A pre-token with its leading space sign, where it has one."""
    return pre_token if pre_token[:1] == "\n" else SPACE + pre_token


class Model:
    """The tokenizer, with the token count of one pre-token."""

    def __init__(self, path: str | None = None) -> None:
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        self.path = path or public_tokenizers.path("piece_bpe_32k.model")
        self.own = SentencePieceProcessor(model_file=self.path)
        self.lead = len(self.own.encode("\n", num_threads=1))

    def check(self) -> Model:
        """Raise if the model's pieces could cross the cuts."""
        names = [self.own.id_to_piece(i) for i in range(self.own.get_piece_size())]
        crossing = [p for p in names if "\n" in p or SPACE in p.lstrip(SPACE)]
        samples = ["ﬁ  Å\t", "a\n  b", SPACE]
        changed = [s for s in samples if self.own.decode(self.own.encode(s)) != s.replace(SPACE, " ")]
        if crossing or changed:
            raise ValueError(f"pieces cross pre-tokens or texts are normalized: {crossing[:3]}{changed}")
        return self

    def counts(self, pre_tokens: list[str]) -> list[int]:
        # behind a line feed no space sign is put in front, and nothing merges with the line feed
        found = self.own.encode(["\n" + whole(p) for p in pre_tokens], num_threads=1)
        return [len(ids) - self.lead for ids in found]


class Known(dict):
    """Token counts by pre-token. One that is not there is noted and counts nothing yet."""

    def __init__(self, counts: dict[str, int]) -> None:
        super().__init__(counts)
        self.missed: list[str] = []

    def __missing__(self, pre_token: str) -> int:
        self.missed.append(pre_token)
        return 0


class Counts:
    """Token counts of texts: the frequent pre-tokens are kept for good, others while there is room."""

    def __init__(self, model: Model, frequent: dict[str, int]) -> None:
        self.model, self.frequent = model, frequent
        self.known = Known(frequent)

    def of(self, texts: list[str]) -> list[int]:
        known = self.known
        seen, ends = [], []
        for t in texts:
            seen.append(sum(map(known.__getitem__, pre_tokens(t))))
            ends.append(len(known.missed))
        missed, known.missed = known.missed, []
        new = list(set(missed))
        counts: dict[str, int] = {}
        for k in range(0, len(new), 10_000):
            part = new[k : k + 10_000]
            counts.update(zip(part, self.model.counts(part), strict=True))
        if len(known) + len(counts) > CACHE:
            self.known = Known(self.frequent)
        if len(counts) <= CACHE:
            self.known.update(counts)
        rest = list(map(counts.__getitem__, missed))
        return [n + sum(rest[a:b]) for n, a, b in zip(seen, [0, *ends], ends, strict=False)]


def frequent_pre_tokens(docs: DataFrame, text: str = "text", most: int = FREQUENT) -> list[str]:
    """About the `most` most frequent pre-tokens of all texts, but for those over `SIGNS` characters."""
    word, group = named(docs, ["word", "group"])
    # cut at single spaces only: what is wrong at other places is missing in the table, no more
    words = docs.select(
        (F.spark_partition_id() % MERGERS).alias(group), F.explode(F.split(F.col(text), " ")).alias(word)
    ).where(F.length(word).between(1, SIGNS) & ~F.contains(word, F.lit("\n")))
    tracked = max(TRACKED, most)
    sketches = words.groupBy(group).agg(F.expr(f"approx_top_k_accumulate(`{word}`, {tracked})").alias("sketch"))
    # grouped, as the combination of an empty partition without a group has no type and fails
    merged = sketches.groupBy(F.col(group) < 0).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    top = merged.select(F.expr(f"approx_top_k_estimate(sketch, {most})").alias("top")).first()
    return [x["item"] for x in (top["top"] or [])] if top else []


def pack(counts: dict[str, int]) -> tuple[bytes, bytes, bytes]:
    """Pre-tokens end to end, their lengths in bytes, and their token counts."""
    raw = [w.encode("utf-8") for w in counts]
    sizes = np.array([len(r) for r in raw], dtype="<u2").tobytes()
    return b"".join(raw), sizes, np.array(list(counts.values()), dtype="<u2").tobytes()


def unpack(packed: tuple[bytes, bytes, bytes]) -> dict[str, int]:
    joined, sizes, tokens = packed
    ends = np.cumsum(np.frombuffer(sizes, dtype="<u2"), dtype=np.int64).tolist()
    words: Iterable[str] = (joined[a:b].decode("utf-8") for a, b in zip([0, *ends], ends, strict=False))
    return dict(zip(words, np.frombuffer(tokens, dtype="<u2").tolist(), strict=True))


def count_tokens(
    docs: DataFrame,
    text: str = "text",
    model: str | None = None,
    limit: int = OVER,
    most: int = FREQUENT,
) -> DataFrame:
    """`docs` plus n_bytes (UTF-8), n_tokens and over_limit (more than `limit` tokens). `model` is a
    file that all workers have; by default the installed public one."""
    yard = Model(model).check()
    frequent = frequent_pre_tokens(docs, text, most)
    packed = pack(dict(zip(frequent, yard.counts(frequent), strict=True)))
    shared = docs.sparkSession.sparkContext.broadcast(packed)
    path, run_id = yard.path, uuid.uuid4().hex
    fields = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType())]
    fields.append(StructField("over_limit", BooleanType()))
    new = {f.name for f in fields}
    keep = [c for c in docs.columns if c.lower() not in new]
    schema = StructType([f for f in docs.schema.fields if f.name in keep] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, key = worker_state(), ("token counts", run_id)
        counts = state.get(key)
        if counts is None:
            # a worker that outlives its job keeps the table of the last one only
            for old in [k for k in state if k[0] == "token counts"]:
                del state[old]
            counts = state[key] = Counts(Model(path), unpack(shared.value))
        for batch in batches:
            texts = [value.as_py() or "" for value in batch.column(text)]
            n_bytes, n_tokens = [len(t.encode("utf-8")) for t in texts], counts.of(texts)
            arrays = [batch.column(c) for c in keep]
            arrays += [pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
            arrays.append(pa.array([n > limit for n in n_tokens], pa.bool_()))
            yield pa.RecordBatch.from_arrays(arrays, names=keep + [f.name for f in fields])

    bounded_batches(docs.sparkSession)
    return spread(docs).mapInArrow(run, schema)
