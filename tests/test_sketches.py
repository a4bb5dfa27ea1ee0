"""Daily sketches: merged windows against exact counts and ranks."""

import bisect
import datetime
import random

from gristmill.operators import sketches
from gristmill.sources import zones
from pyspark.sql import functions as F

D0 = datetime.date(2026, 1, 1)
DAY = datetime.timedelta(days=1)


def test_windows_merge_days_without_reading_records(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 4 == 0, "small").otherwise("big").alias("site_id"),
        F.when(F.col("id") % 97 != 0, F.sha2((F.col("id") % 60_000).cast("string"), 256)).alias("content_hash"),
        F.date_add(F.lit(D0), (F.col("id") % 45).cast("int")).alias("day"),
    )
    daily = sketches.daily_hashes(rows, F.col("day"))
    zones.save_sketches(daily, root, "hashes")
    zones.save_sketches(daily.where(F.col("dt") < F.lit(D0 + 3 * DAY)), root, "hashes")  # a repeat of some days
    stored = zones.read_sketches(spark, root, "hashes")
    assert stored.count() == 90
    merged = sketches.uniqueness_over(stored, F.lit(D0 + 40 * DAY))
    # only the window's days are read
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "struct<site_id:string,records:bigint,hashes:binary>" in plan
    exact = rows.where(F.col("day").between(F.lit(D0 + 11 * DAY), F.lit(D0 + 40 * DAY))).groupBy("site_id")
    exact = {r.site_id: r for r in exact.agg(F.count("*").alias("n"), F.count_distinct("content_hash").alias("u")).collect()}
    for r in merged.collect():
        want = exact[r.site_id]
        assert r.records == want.n
        assert abs(r.distinct_hashes - want.u) <= 0.03 * want.u
        assert abs(r.uniqueness - r.distinct_hashes / want.n) < 1e-9
    assert sketches.uniqueness_over(stored, F.lit(D0 - 1 * DAY)).count() == 0


def test_monthly_percentiles_keep_their_rank(spark):
    rng = random.Random(5)
    rows = []
    for k in range(60_000):
        day = datetime.datetime(2026, 1, 1) + (k % 59) * DAY
        latency = None if k % 50 == 0 else rng.lognormvariate(3, 1)
        rows.append(("d" if k % 3 else "e", day, 200 if k % 5 else 503, None if k % 7 else "x", latency))
    rows.append(("untimed", datetime.datetime(2026, 1, 1), 200, None, None))
    schema = "domain string, ts timestamp, status_code int, error_kind string, latency_ms double"
    daily = sketches.daily_latencies(spark.createDataFrame(rows, schema))
    got = {(r.domain, r.month): r for r in sketches.latency_by_month(daily).collect()}
    assert len(got) == 5
    for (domain, month), r in got.items():
        own = [x for x in rows if x[0] == domain and x[1].month == month.month]
        timed = sorted(x[4] for x in own if x[4] is not None)
        assert r.fetches == len(own)
        assert abs(r.success_rate - sum(x[2] == 200 and x[3] is None for x in own) / len(own)) < 1e-9
        if not timed:
            assert r.latency_ms is None
            continue
        rank = bisect.bisect_right(timed, r.latency_ms) / len(timed)
        assert abs(rank - 0.95) <= 2 * sketches.RANK_ERROR
