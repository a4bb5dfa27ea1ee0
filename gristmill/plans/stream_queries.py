"""Streaming jobs run to the end of a driver table, which must agree with the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.plans.adapters import naive, table
from gristmill.plans.catalog import query
from gristmill.plans.dedupe_queries import TTL_ORACLE
from gristmill.plans.fetch_queries import RESULTS
from gristmill.plans.zone_queries import fresh_root
from gristmill.sources import zones
from gristmill.streaming import jobs, live


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    batch = table(spark, sf_dir, name)
    raw = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    rows = spark.readStream.schema(raw.schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return rows.select(*[F.col(c).cast(kind).alias(c) for c, kind in batch.dtypes])


@query(TTL_ORACLE)
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    records = _stream(spark, sf_dir, "events").select(
        "event_id",
        F.sha2(F.concat("event_type", F.lit("|"), user), 256).alias("content_hash"),
        F.col("ts").alias("started_at"),
        F.lit("events").alias("site_id"),
        F.lit("r1").alias("run_id"),
    )
    root = fresh_root(spark, "stream-dedupe")
    started = jobs.dedupe_stream(records, root, f"{root}/checkpoint", ttl_days=2, order=("event_id",))
    started.awaitTermination()
    schema = "event_id bigint, content_hash string, started_at timestamp"
    kept = zones.read_log(spark, f"{root}/kept", schema)
    return naive(kept.select("event_id", "content_hash", F.col("started_at").alias("kept_at")))


@query(f"WITH {RESULTS} SELECT * FROM timeline")
def stream_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _stream(spark, sf_dir, "events").select(
        F.concat(F.lit("d"), (F.col("user_id") % 10).cast("string")).alias("domain"),
        "ts",
        F.col("event_id").alias("seq"),
        F.col("event_type").isin("error", "signup").alias("failed"),
    )
    root = fresh_root(spark, "stream-breaker")
    jobs.breaker_stream(results, root, f"{root}/checkpoint", fail_max=3).awaitTermination()
    schema = (
        "domain string, ts timestamp, seq bigint, failed boolean, streak bigint, "
        "state_before string, open_after boolean, opened_at timestamp"
    )
    return naive(zones.read_log(spark, f"{root}/timeline", schema).drop("batch"))


def _arriving(spark: SparkSession, rows: DataFrame, folder: str, parts: int = 4) -> DataFrame:
    """`rows` by their `ts` as a stream of `parts` micro-batches, written one after the other."""
    first, last = rows.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    slot = F.floor((F.unix_micros("ts") - F.lit(first)) * parts / F.lit((last or 0) - (first or 0) + 1))
    for k in range(parts):
        rows.where(slot == k).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


LIVE_ORACLE = f"""WITH {RESULTS},
waits AS (
  SELECT domain, ts + INTERVAL 60 SECOND AS due, open_after,
         lead(ts) OVER (PARTITION BY domain ORDER BY ts, seq) AS next FROM timeline)
SELECT domain, 'outcome' AS kind, ts, seq, failed, streak, state_before, open_after, opened_at FROM timeline
UNION ALL
SELECT domain, 'half_open', due, NULL, NULL, NULL, NULL, NULL, NULL FROM waits
WHERE open_after AND coalesce(next >= due, due < (SELECT max(ts) FROM events))"""


@query(LIVE_ORACLE)
def stream_breaker_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timeline and timer events of four micro-batches."""
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("d"), (F.col("user_id") % 10).cast("string")).alias("domain"), "ts",
        F.col("event_id").alias("seq"), F.col("event_type").isin("error", "signup").alias("failed"),
    )
    root = fresh_root(spark, "stream-live")
    results = _arriving(spark, events, f"{root}/arrived")
    live.live_breaker_stream(results, root, f"{root}/checkpoint", fail_max=3).awaitTermination()
    found = spark.read.parquet(f"{root}/live")
    return naive(found.drop("late"))
