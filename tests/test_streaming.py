"""Streaming jobs: several micro-batches and restarts give the batch result."""

import datetime
import random

from gristmill import schemas
from gristmill.operators import breaker, dedupe
from gristmill.sources import registry, zones
from gristmill.streaming import jobs
from test_zones import article, curated, listing, runs

from pyspark.sql import functions as F

T0 = datetime.datetime(2026, 1, 1)
S = datetime.timedelta(seconds=1)


def feed(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_dedupe_over_micro_batches_and_restarts(spark, tmp_path):
    rng = random.Random(1)
    schema = (
        "content_hash string, site_id string, run_id string, started_at timestamp, "
        "page_ord int, element_ord int"
    )
    rows = [
        (rng.choice("aaabc"), "s", f"r{t}", T0 + t * datetime.timedelta(hours=6), i, 0)
        for i, t in enumerate(sorted(rng.choices(range(40), k=120)))
    ]
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for start in range(0, 120, 40):
        chunk = spark.createDataFrame(rows[start : start + 40], schema).coalesce(1)
        chunk.write.mode("append").parquet(source)
        # each round is a new start from the same checkpoint
        query = jobs.dedupe_stream(feed(spark, source, schema), root, f"{tmp_path}/ck", ttl_days=2)
        query.awaitTermination()
    kept = zones.read_log(spark, f"{root}/kept", schema).drop("batch")
    # a run's rows may be split over micro-batches, where its own marks count: compare the batch
    # result at the same times
    batch = dedupe.dedupe_history(spark.createDataFrame(rows, schema), ttl_days=2)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, batch.collect()))


def test_breaker_over_micro_batches_with_late_rows(spark, tmp_path):
    rng = random.Random(2)
    schema = "domain string, ts timestamp, seq bigint, failed boolean"
    rows, at = [], 0
    for seq in range(90):
        at += rng.choice([1, 5, 70])
        rows.append((rng.choice("aab"), T0 + at * S, seq, rng.random() < 0.8))
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for start in range(0, 90, 30):
        chunk = rows[start : start + 30]
        if start == 60:
            chunk = chunk + [("a", T0, 1000, False)]  # late: must rewind nothing
        spark.createDataFrame(chunk, schema).coalesce(1).write.mode("append").parquet(source)
        query = jobs.breaker_stream(feed(spark, source, schema), root, f"{tmp_path}/ck", fail_max=3)
        query.awaitTermination()
    out_schema = schema + ", streak bigint, state_before string, open_after boolean, opened_at timestamp"
    streamed = zones.read_log(spark, f"{root}/timeline", out_schema).drop("batch")
    expected = breaker.breaker_timeline(spark.createDataFrame(rows, schema), fail_max=3)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, expected.collect()))
    late = zones.read_log(spark, f"{root}/late", "domain string, late bigint").collect()
    assert [(r.domain, r.late) for r in late] == [("a", 1)]
    state = jobs.read_breaker_state(spark, root, before=3)
    now = F.lit(rows[-1][1] + 1000 * S)
    for row in jobs.breaker_state_at(state, now, fail_max=3).collect():
        assert row.state == ("half_open" if row.streak >= 3 else "closed")


def test_parse_stream(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    pages = listing(spark, "r1", T0, article(1) + article(2, "free"), "<html></html>")
    pages.coalesce(1).write.parquet(source)
    stream = feed(spark, source, schemas.RAW_PAGES)
    known = runs(spark, ("r1", "books_sandbox", T0))
    jobs.parse_stream(stream, known, registry.default_registry(spark), root, f"{tmp_path}/ck").awaitTermination()
    counts = [spark.read.parquet(f"{root}/{t}").count() for t in ("records", "rejects", "page_errors")]
    assert counts == [1, 1, 1]


def test_gate_stream(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    stream_schema = schemas.RAW_PAGES
    for i, body in enumerate([article(1), article(1), article(2)]):
        page = listing(spark, "?", T0 + i * datetime.timedelta(days=1), body)
        page.coalesce(1).write.mode("append").parquet(source)
        jobs.gate_stream(
            feed(spark, source, stream_schema), registry.default_registry(spark), root, f"{tmp_path}/ck",
            scraper_version="v1",
        ).awaitTermination()
    titles = sorted((r.run, r.title) for r in curated(spark, root).collect())
    assert titles == [("stream-0000000000", "Book 1"), ("stream-0000000002", "Book 2")]
