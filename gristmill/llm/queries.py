"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.llm import (
    bpe,
    chat,
    decontam,
    minhash,
    periodic_runs,
    prefix_trie,
    quality_rules,
    secrets,
    shard,
    substrings,
    token_counts,
    toxicity,
    warc,
)
from gristmill.llm.common import bind
from gristmill.llm.registry import query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


QUALITY_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d
), win AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w)
), twin AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT rid, count(*) AS n
  FROM (SELECT DISTINCT rid, i + k AS p FROM twin, (VALUES (0), (1), (2)) v(k)) GROUP BY rid
), s AS (
  SELECT rid, doc_id, t, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
         len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid)
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         10 * n_symbols > n_words
         OR 2 * word_chars < 5 * n_words OR word_chars > 12 * n_words
         OR 2 * n_dup_lines > n_lines
         OR 3 * n_repeat_words > n_words
         OR 2 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > word_chars
         OR 2 * len(regexp_replace(t, '[^!?]', '', 'g')) > n_words AS rejected
  FROM s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR rejected) AS kept
FROM f
"""


@query(QUALITY_SQL)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document, by the cascade in its estimated order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query()
def op5_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of equal row counts and equal mixture of sources."""
    out = shard.interleave(table(spark, sf_dir, "documents"), n_shards=40)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


@query()
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicates on 3-word shingles at a similarity of 0.85."""
    docs = table(spark, sf_dir, "documents")
    return minhash.near_duplicates(docs, shingle_words=3, percent=85)


@query()
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the bytes decoded from them."""
    return bpe.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"))\
        .select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def _joined(spans, kinds):
    """sha-ready text of spans by start, then kind as listed."""
    order = F.create_map(*[x for k, kind in enumerate(secrets.ALL) for x in (F.lit(kind), F.lit(k))])
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    keyed = F.sort_array(
        F.transform(
            chosen,
            lambda s: F.struct(
                s["start"].alias("a"), order[s["kind"]].alias("o"),
                F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")).alias("t"),
            ),
        )
    )
    return F.array_join(F.transform(keyed, lambda x: x["t"]), ",")


@query()
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document, and how many of them look live."""
    out = secrets.scan(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(_joined("spans", list(secrets.BASE)), 256).alias("base_sha256"),
        _joined("spans", list(secrets.ALL)).alias("spans"),
        F.coalesce(F.size("live"), F.lit(0)).cast("long").alias("n_live"),
    )


@query()
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each document repeats benchmark items, and which."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.mark(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "contaminated", "n_items", "items"
    )


WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p
)
SELECT page_id, strlen(h) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(x, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


@query(WARC_SQL)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated score of every document, learned from the labels outside the held-out fifth."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    out = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    return out.select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


# The tools that turns of `conversations` are read as calls of.
TOOLS = {
    "user": {"properties": {"words": {"type": "integer"}, "query": {"type": "string"}}, "required": ["query", "words"]},
    "system": {"properties": {"query": {"type": "string"}}, "required": ["query"]},
}


@query()
def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns read as tool calls: each turn but the assistant's asks with its whole text, waits for the
    turn two before it, and is answered by the assistant's turn that follows it."""
    rows = table(spark, sf_dir, "conversations")
    arguments = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("query"), F.size(quality_rules.words(F.col("text"))).alias("words")))
    calls = rows.where("role <> 'assistant'").select(
        "conv_id", "turn", F.col("turn").cast("string").alias("call_id"), F.col("role").alias("tool"),
        arguments.alias("arguments"), (F.col("turn") - 2).cast("string").alias("after"),
    )
    results = rows.where("role = 'assistant'").select(
        "conv_id", "turn", (F.col("turn") - 1).cast("string").alias("call_id"), F.col("text").alias("content")
    )
    return chat.link(calls, results, TOOLS)


# Bytes stand as pairs of hexadecimal digits. A byte is removed if one of the fifty strings that begin
# at it or up to 49 bytes before it also begins in a smaller document.
SUBSTRING_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents
), windows AS (
  SELECT doc_id, s, substr(x, 2 * s + 1, 100) AS w
  FROM (SELECT doc_id, x, unnest(range(n - 49)) AS s FROM d WHERE n >= 50)
), firsts AS (
  SELECT w, min(doc_id) AS first FROM windows GROUP BY w
), hits AS (
  SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before
  FROM windows JOIN firsts USING (w) WHERE first < doc_id
), numbered AS (
  SELECT doc_id, s, sum((before IS NULL OR s > before + 50)::INT) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM hits
), spans AS (
  SELECT doc_id, k, min(s) AS a, max(s) + 50 AS b FROM numbered GROUP BY doc_id, k
), gaps AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS from_byte FROM spans
), kept AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
         string_agg(substr(x, 2 * from_byte + 1, 2 * (a - from_byte)), '' ORDER BY a) AS k
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN x ELSE k || substr(x, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query(SUBSTRING_SQL)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a 50-byte string of an earlier one covers."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


@query()
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it has more than 4096 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def _with_period(text: Column, doc_id: Column) -> Column:
    """The text with a planted repeat at its end, for a tenth of the ids; other texts as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        # bound, as the places of every word are computed from them
        return bind(
            F.struct(a.alias("a"), p.alias("p"), w.alias("w")),
            lambda x: F.array_join(
                F.transform(
                    F.sequence(F.lit(0), F.size(x["w"]) - 1),
                    lambda i: F.when(i < x["a"], x["w"][i]).otherwise(x["w"][x["a"] + (i - x["a"]) % x["p"]]),
                ),
                " ",
            ),
        )

    planted = bind(quality_rules.words(text), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(text))
    return F.when(h % 10 == 0, planted).otherwise(text)


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeating words in every document, a tenth of them with a planted one."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", _with_period(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs.find_runs(docs)
    # exact comparison of length / period; of ties the first in order, by start and period, stays
    best = F.reduce(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))),
        F.get("runs", F.lit(0)),
        lambda top, r: F.when(r["length"] * top["period"] > top["length"] * r["period"], r).otherwise(top),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _shared_starts(turns: DataFrame) -> DataFrame:
    """Every conversation rebuilt: it opens with the first h turns of its family's first one."""
    family = turns.withColumn("family", F.col("conv_id") - F.col("conv_id") % 5)
    # one exchange serves the ranks and the family's facts; the rows are narrow, and spill
    family = family.repartition("family")
    whole = Window.partitionBy("family")
    placed = family.select(
        "conv_id", "content", "n_bytes", "family",
        (F.row_number().over(prefix_trie.in_order("family", "conv_id")) - 1).alias("i"),
        F.collect_set("conv_id").over(whole).alias("members"),  # five at most
        F.count_if(F.col("conv_id") == F.col("family")).over(whole).alias("opening"),
    )

    def h(c: Column) -> Column:
        return F.crc32(c.cast("string").cast("binary")) % 9

    opens = F.col("conv_id") == F.col("family")
    takers = F.filter(
        "members", lambda c: (opens & (F.col("i") < h(c))) | ((c == F.col("conv_id")) & (F.col("i") >= h(c)))
    )
    shared = opens & (F.col("i") < h(F.col("taker")))
    after = F.least(h(F.col("taker")), F.col("opening")) + F.col("i") - h(F.col("taker"))
    return placed.withColumn("taker", F.explode(takers)).select(
        F.col("taker").alias("conv_id"), F.when(shared, F.col("i")).otherwise(after).alias("turn"), "content", "n_bytes"
    )


TRIE_SQL = """
WITH bits AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT] || list_transform(range(8), lambda k: 0::BIGINT),
         lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t
), convs AS (
  SELECT conv_id AS c, conv_id - conv_id % 5 AS b, xor(list_reduce(
           [4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
           lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), bits
), turns AS (
  SELECT conv_id, list(md5(length(role) || ':' || role || text) || ' ' || strlen(text) ORDER BY turn NULLS FIRST) AS w
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
  GROUP BY conv_id
), rebuilt AS (
  SELECT c, list_concat(coalesce(o.w[1:h], []), t.w[h + 1:]) AS w
  FROM convs JOIN turns t ON t.conv_id = c LEFT JOIN turns o ON o.conv_id = b
), paths AS (
  SELECT c, d, len(w) = d AS ends, array_to_string(w[1:d], ',') AS k,
         CASE WHEN d > 0 THEN array_to_string(w[1:d - 1], ',') END AS p,
         CASE WHEN d > 0 THEN string_split(w[d], ' ')[2]::BIGINT ELSE 0 END AS n_bytes
  FROM (SELECT c, w, unnest(range(len(w) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT k, d AS depth, any_value(p) AS p, min(c) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(n_bytes) AS saved,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM paths GROUP BY k, d
), children AS (
  SELECT p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY p
), facts AS (
  SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children ON children.p = nodes.k
), subtrees AS (
  SELECT paths.k, sum(f.saved) AS saved, count(*) FILTER (f.n_children = 0) AS n_leaves
  FROM facts f JOIN paths own ON own.c = f.conv_id AND own.k = f.k
       JOIN paths ON paths.c = f.conv_id AND paths.d <= f.depth
  GROUP BY paths.k
)
SELECT f.conv_id, f.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children,
       s.n_leaves, s.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM facts f JOIN subtrees s USING (k) LEFT JOIN nodes up ON up.k = f.p
"""


@query(TRIE_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    turns = prefix_trie.keyed(table(spark, sf_dir, "conversations"))
    return prefix_trie.build(_shared_starts(turns), turns)
