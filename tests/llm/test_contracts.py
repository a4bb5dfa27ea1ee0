"""Registered queries over whole small tables against plain programs, where SQL has no words."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from gristmill.llm import registry, warc

SMALL = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    return {r.doc_id: r for r in rows}


def run(spark, name):
    registry.load_all()
    return registry.QUERIES[name](spark, SMALL).collect()


def test_shards(spark, texts):
    got = run(spark, "op5_stratified_shards")
    assert sorted(r.doc_id for r in got) == sorted(texts)
    slots = defaultdict(list)
    mixture = defaultdict(Counter)
    for r in got:
        raw = (texts[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 40
        slots[r.shard].append(r.slot)
        mixture[r.shard][texts[r.doc_id].source] += 1
    sizes = [len(slots[k]) for k in range(40)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    whole = Counter(r.source for r in texts.values())
    for k in range(40):
        for source, n in whole.items():
            assert abs(mixture[k][source] - n * sizes[k] / len(texts)) <= 2


ASSIGN = re.compile(r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
                    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")  # fmt: skip
KINDS = [
    ("assign", ASSIGN, lambda m: len(m[1]) >= 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def test_secret_spans(spark):
    # the smallest table holds no secrets
    registry.load_all()
    texts = {r.doc_id: r for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    got = registry.QUERIES["op8_secrets"](spark, LARGER).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    total = 0
    for r in got:
        spans = []
        for k, (kind, pattern, enough) in enumerate(KINDS):
            own = [m.span() for m in pattern.finditer(texts[r.doc_id].text or "") if enough(m)]
            assert r[f"n_{kind}"] == len(own)
            spans += [(a, k, f"{kind}:{a}:{b}") for a, b in own]
        base = [s for _, _, s in sorted(spans)]
        total += len(base)
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(","))
    assert total > 0


def test_toxicity_law(spark, texts):
    got = run(spark, "op9_toxicity")
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_a_very_long_url_is_read_back(spark):
    pages = spark.createDataFrame([(1, "http://x.example/" + "y" * 3_000_000, "<p>a</p>")], "page_id long, url string, html string")
    assert [(r.page_id, r.payload_bytes) for r in warc.round_trip(pages).collect()] == [(1, 8)]
