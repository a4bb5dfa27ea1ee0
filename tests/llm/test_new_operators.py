"""Periodic runs, prefix tries and token counts against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from gristmill.llm import periodic_runs, prefix_trie, registry, token_counts

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- periodic runs


def all_runs(w, min_words=24, min_periods=3):
    """Every stretch of every period by direct comparison; of equal stretches the smallest period."""
    out = {}
    for q in range(1, len(w) // min_periods + 1):
        k = 0
        while k < len(w) - q:
            s = k
            while k < len(w) - q and w[k] == w[k + q]:
                k += 1
            if k > s and k + q - s >= max(min_words, min_periods * q):
                out.setdefault((s, k + q), q)
            k += 1
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def random_words(rng):
    n = rng.choice([0, 1, 5, 23, 24, 30, 60, 150, 400])
    kind = rng.randint(0, 4)
    if kind == 0:
        return [rng.randint(0, 1) for _ in range(n)]
    if kind == 1:
        return [0] * n
    if kind == 2:
        base = [rng.randint(0, 2) for _ in range(rng.randint(1, 12))]
        w = [base[i % len(base)] for i in range(n)]
        for _ in range(rng.randint(0, 3) if n else 0):
            w[rng.randrange(n)] = 3
        return w
    if kind == 3:
        w = []
        while len(w) < n:
            w += [rng.randint(0, 3) for _ in range(rng.randint(1, 6))] * rng.randint(1, 9)
        return w * rng.randint(1, 4)
    return [rng.randint(0, 50) for _ in range(n)]


@pytest.mark.parametrize("seed", range(8))
def test_runs_match_direct_comparison(seed):
    rng = random.Random(seed)
    for _ in range(25):
        texts = [np.array(random_words(rng), dtype=np.int64) for _ in range(rng.randint(1, 6))]
        bounds = rng.choice([(24, 3), (4, 3), (12, 4), (1, 3)])
        for text, found in zip(texts, periodic_runs.runs(texts, *bounds), strict=True):
            assert [tuple(r) for r in found.tolist()] == all_runs(text.tolist(), *bounds)


def test_extensions_match_direct_comparison():
    rng = np.random.default_rng(3)
    for size, signs in ((300, 2), (2000, 3), (1, 1), (2, 1)):
        w = np.append(rng.integers(0, signs, size), signs)
        w[size // 3 : 2 * (size // 3)] = w[: size // 3]
        levels = periodic_runs.grammar(w)
        i, j = np.meshgrid(np.arange(0, size, 7), np.arange(0, size + 1, 5))
        i, j = i[i < j], j[i < j]
        want = [next(k for k in range(size + 1) if w[a + k] != w[b + k]) for a, b in zip(i, j, strict=True)]
        assert periodic_runs.common_extension(levels, i, j).tolist() == want


def test_runs_of_documents(spark):
    data = [
        (1, " ".join(["a b c"] * 10) + " d end", "x"), (2, None, "x"), (3, "", "x"), (None, "a " * 24, "x"),
        (1, " ".join(["a b c"] * 10) + " d end", "x"), (5, "long " * 200_000, "x"), (6, "one two\n\tthree ", "x"),
    ]
    df = spark.createDataFrame(data, "doc_id long, text string, Runs string").repartition(3)
    got = periodic_runs.find_runs(df)
    assert got.columns == ["doc_id", "text", "runs", "collapsed"]
    seen = sorted(((r.doc_id or 0), [tuple(x) for x in r.runs], r.collapsed) for r in got.collect())
    assert seen == [
        (0, [(0, 24, 1)], "a"), (1, [(0, 29, 3)], "a b c c d end"),
        (1, [(0, 29, 3)], "a b c c d end"), (2, [], ""), (3, [], ""), (5, [(0, 200_000, 1)], "long"), (6, [], "one two three"),
    ]
    assert periodic_runs.find_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="three periods"):
        periodic_runs.runs([np.zeros(9, dtype=np.int64)], 4, 2)


def test_registered_runs(spark):
    registry.load_all()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = registry.QUERIES["op11_periodic_runs"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert sum(r.n_runs > 0 for r in got) > 10
    for r in got:
        w = WORD.findall(texts[r.doc_id] or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        own = all_runs(w)
        best = None
        for run in own:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        gone = {k for s, size, p in own for k in range(s + p, s + size)}
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (
            len(own), *(best or [None] * 3), 1000 * best[1] // best[2] if best else None
        )
        assert r.runs_sha256 == sha("".join(f"{s},{size},{p}\n" for s, size, p in own))
        assert r.collapsed_sha256 == sha(" ".join(x for k, x in enumerate(w) if k not in gone))


# ---- prefix trie


def trie(sequences):
    """Nodes of a dict of conversations, by walking over all prefixes."""
    members = defaultdict(list)
    for c, w in sequences.items():
        for d in range(len(w) + 1):
            members[tuple(w[:d])].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    below = {}
    for k in sorted(members, key=len, reverse=True):
        saved = (len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0
        leaves = 0 if children[k] else 1
        for x in children[k]:
            saved, leaves = saved + below[x][0], leaves + below[x][1]
        below[k] = saved, leaves
    return sorted(
        (
            min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), len(children[k]), below[k][1], below[k][0],
            sha(",".join(str(c) for c in sorted(m) if len(sequences[c]) == len(k))),
        )
        for k, m in members.items()
    )


def nodes(df):
    return sorted(
        (
            r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
            r.n_leaves, r.saved_tokens, r.ends_sha256,
        )
        for r in df.collect()
    )


TURNS = "conv_id long, turn long, role string, text string, block string, content string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "b", "c") for r in rows], TURNS).repartition(3)


@pytest.mark.parametrize("width", [1, 3, 8])
def test_trie_matches_a_walk(spark, width):
    rng = random.Random(width)
    sequences = {}
    for c in list(range(-3, 40)) + [10_000 + k for k in range(30)]:
        base = rng.choice([[], *sequences.values()])
        w = base[: rng.randint(0, len(base))] + [(rng.choice("ua"), rng.choice(["", "é", "abc"])) for _ in range(rng.choice([0, 1, 2, 20]))]
        sequences[c] = w
    sequences[77] = sequences[78] = [("u", "x" * k) for k in range(60)]
    rows = [(c, t, *x) for c, w in sequences.items() for t, x in enumerate(w)]
    df = table(spark, rows)
    ids = spark.createDataFrame([(c,) for c in [*sequences, None, 77]], "conv_id long")
    assert nodes(prefix_trie.build(prefix_trie.keyed(df), ids, width)) == trie(sequences)


def test_trie_edge_cases(spark):
    rows = [
        (None, 1, "u", "lost"), (1, None, None, None), (1, 2, "u", "x" * 2_000_000), (2, 5, "", ""), (2, 9, "u", "x" * 2_000_000),
        (3, 1, "u", "tie"), (3, 1, "a", "tie"), (4, 7, "a", "tie"), (4, 7, "u", "tie"), (5, 1, "u", "same"), (5, 1, "u", "same"),
        (6, 0, "u:", "v"), (7, 0, "u", ":v"),
    ]
    got = nodes(prefix_trie.build(prefix_trie.keyed(table(spark, rows))))
    assert [r[3] for r in got if r[1] == 0] == [7]
    by = {(r[0], r[1]): r for r in got}
    # null and empty are alike, ties fall in one order, repeated turns are turns, texts are not glued to roles
    assert by[1, 2][3] == 2 and by[3, 2][3] == 2 and by[5, 2][3] == 1 and by[6, 1][3] == by[7, 1][3] == 1
    assert by[1, 1][6] == 2_000_000
    nothing = table(spark, rows).limit(0)
    assert prefix_trie.build(prefix_trie.keyed(nothing), nothing).count() == 0


def test_one_common_conversation(spark):
    same = [("u", f"turn {k}") for k in range(11)]
    sequences = {c: same for c in range(9000)} | {9000 + k: [*same[:9], ("a", str(k))] for k in range(500)}
    df = spark.createDataFrame([(c, t, *x, "", "") for c, w in sequences.items() for t, x in enumerate(w)], TURNS)
    assert nodes(prefix_trie.build(prefix_trie.keyed(df.repartition(4)))) == trie(sequences)


# ---- token counts


def test_counts_equal_the_tokenizer(spark):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    yard = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = [
        None, "", " ", "  ", "\n", "\n\n a\n  b", " lead", "trail ", "a  b   c", "▁ ▁x", "a▁b", "<s> </s> <unk><0x0A>", "漢字 kana かな 👍🏽",
        "\x00\t\r\x0b  x", "long" * 100_000, "word " * 5000, "x\n" * 5000, "ﬁ Å é", "﻿a", "1234567 89",
    ]
    rng = random.Random(0)
    texts += ["".join(rng.choice(" \n▁aeb,.é") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] * 2, "doc_id long, text string, N_Tokens string")
    for most in (1, 100):
        got = token_counts.count_tokens(df.repartition(5), limit=3, most=most)
        assert got.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"]
        rows = got.collect()
        assert len(rows) == 2 * len(texts)
        for r in rows:
            n = len(yard.encode(r.text or ""))
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 3)
    assert token_counts.count_tokens(df.limit(0)).count() == 0


def test_pre_tokens_join_to_the_text():
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice(" \n▁ab") for _ in range(rng.randint(0, 12)))
        pieces = [token_counts.whole(p) for p in token_counts.pre_tokens(text)]
        assert "".join(pieces) == (("▁" + text.replace(" ", "▁")) if text else "")


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE", 5)
    counts = token_counts.Counts(token_counts.Model(), {"the": 1})
    texts = [f"the word{k} other{k % 3}" for k in range(40)]
    want = token_counts.Counts(token_counts.Model(), {}).model
    for k in range(0, 40, 4):
        assert counts.of(texts[k : k + 4]) == [len(want.own.encode(t)) for t in texts[k : k + 4]]
        assert len(counts.known) <= 5 and counts.known["the"] == 1


def test_packed_table():
    table = {"": 1, "é▁x": 3, "\x00": 9}
    assert token_counts.unpack(token_counts.pack(table)) == table
    assert token_counts.unpack(token_counts.pack({})) == {}


def test_registered_counts(spark):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    registry.load_all()
    yard = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = registry.QUERIES["op13_token_counts"](spark, SMALL).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(yard.encode(t)) for i, t in texts.items()}
