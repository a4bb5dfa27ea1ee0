"""Secret scans with corpus-wide ownership frequency.

Candidates are found by pattern in every whole text. Their hashes are then counted over the corpus
by distinct repositories and distinct owners. A value that several owners have is a copied example;
one that a single owner has, and that looks random, is taken for a live credential of that owner.

Counts are made in two steps (distinct values per repository and owner, then counts), so a value
that stands in a third of all rows is a few rows by the second shuffle.

Rows: a null text is empty and has no spans. A null repository or owner is one of its own. Repeated
rows are scanned one by one. Extra columns are not carried along by `scan`; `redact` keeps them all.
No rows in, none out.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import bounded_batches, named, spread
from gristmill.session import cut, drop

# The base kinds in their order, with the pattern and the group and length kept.
BASE = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}
# Kinds that the method adds: keys in armour and tokens with a vendor's prefix.
ADDED = {
    "armour": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    "prefixed": (r"\b(?:gh[pousr]_|sk_live_|xox[abpr]-|glpat-)([A-Za-z0-9_-]+)", 1, 16),
}
ALL = [*BASE, *ADDED]
# Owners from which on a value counts as a copied example.
SHARED_OWNERS = 2
# Bits per character from which on a value looks random.
RANDOM_BITS = 2.5
# Live values that redaction gives to every task, at 32 characters each.
LIVE_VALUES = 200_000

SPAN = "kind string, start int, end int, value_hash string, random boolean"


def spans_of(text: str, rules: dict[str, re.Pattern]) -> list[tuple]:
    """(start, order of the kind, kind, end, value) of all spans, in order."""
    out = []
    for order, (kind, (_, group, least)) in enumerate({**BASE, **ADDED}.items()):
        for m in rules[kind].finditer(text):
            value = m[group]
            if len(value) >= least:
                out.append((m.start(), order, kind, m.end(), value))
    return sorted(out)


def _digest(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()[:32]


def _random(value: str) -> bool:
    counts = [value.count(c) for c in set(value)]
    return -sum(n / len(value) * math.log2(n / len(value)) for n in counts) >= RANDOM_BITS


def _compiled() -> dict[str, re.Pattern]:
    flags = {"assign": re.ASCII | re.IGNORECASE}
    return {k: re.compile(p, flags.get(k, re.ASCII)) for k, (p, _, _) in {**BASE, **ADDED}.items()}


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` plus `found`, the array of its spans; values only as hashes."""
    (name,) = named(docs, ["found"])
    schema = f"{name} array<struct<{SPAN.replace(' ', ':').replace(',:', ',')}>>"
    kind = pa.list_(
        pa.struct(
            [
                ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                ("value_hash", pa.string()), ("random", pa.bool_()),
            ]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = _compiled()
        for batch in batches:
            found = []
            for value in batch.column(text):
                found.append(
                    [
                        {
                            "kind": k, "start": s, "end": e,
                            "value_hash": _digest(v), "random": _random(v),
                        }
                        for s, _, k, e, v in spans_of(value.as_py() or "", rules)
                    ]
                )
            columns = [batch.column(i) for i in range(batch.num_columns)] + [pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, name])

    bounded_batches(docs.sparkSession)
    from pyspark.sql.types import StructType

    out = StructType(docs.schema.fields + StructType.fromDDL(schema).fields)
    return spread(docs).mapInArrow(run, out)


def ownership(values: DataFrame) -> DataFrame:
    """value_hash, n_repositories and n_owners from (value_hash, repository, owner) rows."""
    distinct = values.distinct()
    repos = distinct.select("value_hash", "repository").distinct().groupBy("value_hash")
    owners = distinct.select("value_hash", "owner").distinct().groupBy("value_hash")
    return repos.agg(F.count(F.lit(1)).alias("n_repositories")).join(
        owners.agg(F.count(F.lit(1)).alias("n_owners")), "value_hash"
    )


def live_values(found: DataFrame, repository: str, owner: str, shared_owners: int) -> DataFrame:
    """Hashes of the values that look live: random, and with fewer owners than a copied example."""
    spans = found.select(
        F.col(repository).alias("repository"), F.col(owner).alias("owner"), F.explode("spans").alias("s")
    ).where("s.random")
    # both counts read the distinct values, which are found once
    values = spans.select(F.col("s.value_hash").alias("value_hash"), "repository", "owner").distinct()
    counted = ownership(cut(values, "secret-owners"))
    return counted.where(F.col("n_owners") < shared_owners)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    repository: str = "source",
    owner: str = "source",
    shared_owners: int = SHARED_OWNERS,
) -> DataFrame:
    """doc_id, repository, owner, spans, and live (the start places of spans that look live)."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text).alias("text"),
        F.col(repository).alias("repository"), F.col(owner).alias("owner"),
    )
    rows = find(rows).select("doc_id", "repository", "owner", F.col("found").alias("spans"))
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()), "secret-spans")
    live = live_values(rows, "repository", "owner", shared_owners)
    marked = (
        rows.select("row", F.explode("spans").alias("s"))
        .select("row", F.col("s.start").alias("start"), F.col("s.value_hash").alias("value_hash"), F.col("s.random").alias("random"))
        .where("random").join(live.select("value_hash"), "value_hash", "left_semi")
        .groupBy("row").agg(F.array_sort(F.collect_set("start")).alias("live"))
    )
    return rows.join(marked, "row", "left").drop("row")


def _cleaned(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """The text with `mark` for every span; of spans that overlap each has its mark."""
    out, at = [], 0
    for start, end in sorted(spans):
        if end > at:
            out += [text[at : max(at, start)], mark]
            at = end
    return "".join([*out, text[at:]])


def _redact_known(docs: DataFrame, text: str, mark: str, live: frozenset[str]) -> DataFrame:
    """`docs` with `mark` in the place of spans with a random value among `live`; one scan, no shuffle."""
    known = docs.sparkSession.sparkContext.broadcast(live)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = _compiled()
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for k, t in enumerate(texts):
                spans = [
                    (s, e) for s, _, _, e, v in spans_of(t or "", rules) if _digest(v) in known.value and _random(v)
                ]
                if spans:
                    texts[k] = _cleaned(t, spans, mark)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def redact(
    docs: DataFrame,
    text: str = "text",
    repository: str = "source",
    owner: str = "source",
    mark: str = "<secret>",
    shared_owners: int = SHARED_OWNERS,
) -> DataFrame:
    """`docs` with `mark` in the place of every span that looks live; all rows and columns stay.

    The values are found in a first scan, of which narrow rows alone are shuffled. Up to LIVE_VALUES live
    ones go to the tasks of a second scan; beyond that, rows are joined with their live spans.
    """
    owned = docs.select(
        F.col(text).alias("text"), F.col(repository).alias("repository"), F.col(owner).alias("owner")
    )
    owned = find(owned).select("repository", "owner", F.col("found").alias("spans"))
    live = cut(live_values(owned, "repository", "owner", shared_owners).select("value_hash"), "secret-live")
    if live.count() > LIVE_VALUES:
        return _redact_joined(docs, text, mark, live)
    known = frozenset(r.value_hash for r in live.collect())
    drop(live)
    return _redact_known(docs, text, mark, known)


def _redact_joined(docs: DataFrame, text: str, mark: str, live: DataFrame) -> DataFrame:
    """As `_redact_known`, for any number of live values: rows are joined with their live spans."""
    name, row, live_at = named(docs, ["found", "row", "live_at"])
    found = cut(find(docs, text).withColumn(row, F.monotonically_increasing_id()), "secret-redact")
    spans = found.where(F.size(name) > 0).select(row, F.col(name).alias("spans"))
    marked = (
        spans.select(row, F.explode("spans").alias("s"))
        .select(row, F.col("s.start").alias("a"), F.col("s.end").alias("b"), F.col("s.value_hash").alias("value_hash"), F.col("s.random").alias("random"))
        .where("random").join(live, "value_hash", "left_semi")
        .groupBy(row).agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias(live_at))
    )
    t = F.col(text)
    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("at"))

    def step(acc, x):
        skip = x["b"] <= acc["at"]
        head = F.substring(t, acc["at"] + 1, F.greatest(x["a"] - acc["at"], F.lit(0)))
        grown = F.struct(F.concat(acc["s"], head, F.lit(mark)).alias("s"), x["b"].alias("at"))
        return F.when(skip, acc).otherwise(grown)

    cleaned = F.aggregate(
        live_at, start, step, lambda acc: F.concat(acc["s"], F.substring(t, acc["at"] + 1, F.char_length(t)))
    )
    out = found.join(marked, row, "left").withColumn(
        text, F.when(F.col(live_at).isNull(), t).otherwise(cleaned)
    )
    return out.select(*docs.columns)
