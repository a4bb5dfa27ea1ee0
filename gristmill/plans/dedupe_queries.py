"""Dedupe queries over `documents` (content) and `events` (repeats over time)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators import dedupe
from gristmill.plans.adapters import documents, naive, table
from gristmill.plans.catalog import query

DOCS = """
docs AS (
  SELECT doc_id, source AS site_id, sha256(text) AS content_hash, doc_id % 2 AS run,
         TIMESTAMP '2026-01-01' + INTERVAL 30 DAY * (doc_id % 2) AS started_at
  FROM documents)"""


@query(
    f"""WITH {DOCS}
    SELECT doc_id, site_id, content_hash FROM docs
    QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY doc_id) = 1"""
)
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedupe.dedupe_batch(documents(spark, sf_dir), order=("doc_id",))
    return kept.select("doc_id", "site_id", "content_hash")


def _two_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = documents(spark, sf_dir)
    first = dedupe.dedupe_batch(docs.filter("run_id = 'r0'"), order=("doc_id",))
    second = dedupe.dedupe_batch(docs.filter("run_id = 'r1'"), order=("doc_id",))
    return dedupe.seen_rows(first), second


TWO_RUNS = f"""{DOCS},
kept AS (
  SELECT * FROM docs d
  QUALIFY row_number() OVER (PARTITION BY content_hash, run ORDER BY doc_id) = 1),
fresh AS (
  SELECT * FROM kept k WHERE run = 1
  AND NOT EXISTS (SELECT 1 FROM kept o WHERE o.run = 0 AND o.content_hash = k.content_hash))"""


@query(f"WITH {TWO_RUNS} SELECT doc_id, site_id, content_hash FROM fresh")
def dedupe_cross_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, second = _two_runs(spark, sf_dir)
    return dedupe.drop_seen(second, seen).select("doc_id", "site_id", "content_hash")


@query(
    f"""WITH {TWO_RUNS}
    SELECT content_hash, site_id, started_at AS first_seen,
           started_at + INTERVAL 90 DAY AS expires_at, 'r' || run AS run_id
    FROM (SELECT * FROM kept WHERE run = 0 UNION ALL SELECT * FROM fresh)"""
)
def dedupe_mark_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, second = _two_runs(spark, sf_dir)
    return naive(dedupe.mark_seen(seen, dedupe.seen_rows(dedupe.drop_seen(second, seen))))


def _repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    return events.select(
        "event_id",
        F.sha2(F.concat("event_type", F.lit("|"), user), 256).alias("content_hash"),
        F.col("ts").alias("started_at"),
    )


REPEATS = """
repeats AS (
  SELECT event_id, ts, sha256(event_type || '|' || CAST(user_id AS VARCHAR)) AS content_hash
  FROM events),
chain AS (
  SELECT content_hash, min(ts) AS ts FROM repeats GROUP BY content_hash
  UNION ALL
  SELECT content_hash, ts FROM (
    SELECT r.content_hash, r.ts,
           row_number() OVER (PARTITION BY r.content_hash ORDER BY r.ts) AS k
    FROM repeats r JOIN chain c
      ON r.content_hash = c.content_hash AND r.ts >= c.ts + INTERVAL 2 DAY)
  WHERE k = 1)"""

TTL_ORACLE = f"""WITH RECURSIVE {REPEATS}
    SELECT min(event_id) AS event_id, content_hash, ts AS kept_at
    FROM chain JOIN repeats USING (content_hash, ts) GROUP BY content_hash, ts"""


@query(TTL_ORACLE)
def dedupe_ttl_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedupe.dedupe_history(_repeats(spark, sf_dir), ttl_days=2, order=("event_id",))
    return naive(kept.select("event_id", "content_hash", F.col("started_at").alias("kept_at")))


@query(TTL_ORACLE)
def dedupe_ttl_backfill_in_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every longer chain linked over time slices, as a hot hash would be."""
    kept = dedupe.dedupe_history(
        _repeats(spark, sf_dir), ttl_days=2, order=("event_id",), fold_limit=12
    )
    return naive(kept.select("event_id", "content_hash", F.col("started_at").alias("kept_at")))
