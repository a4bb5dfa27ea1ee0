"""Byte-level BPE: encoding by longest matches with backtracking, and decoding.

A text is cut into pieces by the tokenizer's pattern. A piece that is a token is that token. In any
other, pyahocorasick finds all tokens at all places over the bytes mapped to Latin-1. The encoder
takes the longest token at each place, shorter ones after a conflict, and steps back when none
fits. A token may follow another exactly when merging their joined bytes gives the two back; this
is memoised per pair. A sequence of tokens whose neighbours are all compatible is the one that the
merges produce, and a place from which no such sequence continues is tried once, so work is linear
in the piece.

Rows: a null text is the empty text, with no tokens. Extra columns are carried along; result columns
replace columns of the same name. Repeated rows are encoded one by one. No rows in, none out.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from gristmill.llm.common import bounded_batches, spread, worker_state

# Entries of a memo before it is emptied; results do not depend on it.
MEMO = 500_000


def merged(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Tokens of a short byte string by merging the pair of lowest rank, leftmost first."""
    parts = [raw[i : i + 1] for i in range(len(raw))]
    while len(parts) > 1:
        best = min(
            ((ranks.get(parts[i] + parts[i + 1], -1), i) for i in range(len(parts) - 1)),
            key=lambda x: (x[0] < 0, x),
        )
        if best[0] < 0:
            break
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


class Encoder:
    def __init__(self, lines: bytes, pattern: str) -> None:
        self.ranks = {
            base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x.strip())
        }
        self.bytes = {r: b for b, r in self.ranks.items()}
        self.split = regex.compile(pattern)
        self.tokens = ahocorasick.Automaton()
        for raw, rank in self.ranks.items():
            self.tokens.add_word(raw.decode("latin-1"), rank)
        self.tokens.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.alone: dict[int, bool] = {}
        self.pieces = Packed(self)

    def _stands(self, token: int) -> bool:
        """Do the merges ever produce this token from its bytes?"""
        ok = self.alone.get(token)
        if ok is None:
            ok = self.alone[token] = merged(self.bytes[token], self.ranks) == [token]
        return ok

    def _follows(self, left: int, right: int) -> bool:
        ok = self.pairs.get((left, right))
        if ok is None:
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            joined = self.bytes[left] + self.bytes[right]
            ok = self.pairs[left, right] = merged(joined, self.ranks) == [left, right]
        return ok

    def _piece(self, raw: bytes) -> list[int]:
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        size = len(raw)
        at: list[list[int]] = [[] for _ in range(size)]
        for end, rank in self.tokens.iter(raw.decode("latin-1")):
            at[end + 1 - len(self.bytes[rank])].append(rank)
        for found in at:
            found.sort(key=lambda r: -len(self.bytes[r]))
        dead = set()
        # choices made: place, token, and where to go on in the place's list after a step back
        path: list[tuple[int, int, int]] = []
        place, k = 0, 0
        while place < size:
            options = at[place]
            last = path[-1][1] if path else None
            while k < len(options):
                token = options[k]
                k += 1
                end = place + len(self.bytes[token])
                if (end, token) in dead or not self._stands(token):
                    continue
                if last is None or self._follows(last, token):
                    path.append((place, token, k))
                    place, k = end, 0
                    break
            else:
                if not path:
                    raise ValueError("the vocabulary lacks a byte of the text")
                place, token, k = path.pop()
                # whether a sequence goes on after a token depends on the token and place alone
                dead.add((place + len(self.bytes[token]), token))
        return [token for _, token, _ in path]

    def packed(self, text: str) -> bytes:
        """Token ids of a text, as little-endian unsigned 32-bit integers."""
        pieces = self.split.findall(text)
        if len(self.pieces) >= MEMO:
            self.pieces.clear()
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class Packed(dict):
    """Packed ids by piece; a piece that is not there is encoded, and kept unless it is long."""

    def __init__(self, encoder: Encoder) -> None:
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = np.asarray(self.encoder._piece(piece.encode("utf-8")), dtype="<u4").tobytes()
        if len(piece) <= 64 and len(self) < 2 * MEMO:
            self[piece] = ids
        return ids


def _encoder(path: str | None) -> Encoder:
    """The worker's encoder of a vocabulary, which outlives the task."""
    state, key = worker_state(), ("byte-level BPE", path)
    if key not in state:
        state[key] = Encoder(*_vocabulary(path))
    return state[key]


def _vocabulary(path: str | None) -> tuple[bytes, str]:
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def encode_and_decode(
    docs: DataFrame,
    text: str = "text",
    vocabulary: str | None = None,
    with_ids: bool = False,
    with_decoded: bool = False,
) -> DataFrame:
    """`docs` plus n_tokens, ids_sha256 and decoded_sha256; ids (binary, little-endian unsigned
    32-bit integers) and decoded text where asked for. `vocabulary` is a file that all workers
    have; by default the installed public one."""
    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType())]
    fields.append(StructField("decoded_sha256", StringType()))
    if with_ids:
        fields.append(StructField("ids", BinaryType()))
    if with_decoded:
        fields.append(StructField("decoded", StringType()))
    new = {f.name for f in fields}
    keep = [c for c in docs.columns if c.lower() not in new]
    schema = StructType([f for f in docs.schema.fields if f.name in keep] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for batch in batches:
            columns: list[list] = [[] for _ in fields]
            for value in batch.column(text):
                packed = encoder.packed(value.as_py() or "")
                raw = encoder.decode(np.frombuffer(packed, dtype="<u4").tolist())
                n = len(packed) // 4
                row = [n, hashlib.sha256(packed).hexdigest(), hashlib.sha256(raw).hexdigest()]
                row += [packed] * with_ids + [raw.decode("utf-8")] * with_decoded
                for c, v in zip(columns, row, strict=True):
                    c.append(v)
            arrays = [batch.column(c) for c in keep]
            kinds = {LongType: pa.int64(), StringType: pa.string(), BinaryType: pa.binary()}
            arrays += [pa.array(c, kinds[type(f.dataType)]) for c, f in zip(columns, fields, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=keep + [f.name for f in fields])

    bounded_batches(docs.sparkSession)
    return spread(docs).mapInArrow(run, schema)
