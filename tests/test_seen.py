"""Seen hashes: lookups without a shuffle of the state, repeats, snapshots, point reads."""

import datetime
import re

import pytest
from gristmill import schemas
from gristmill.operators import dedupe
from gristmill.sources import seen
from pyspark.sql import functions as F

T0 = datetime.datetime(2026, 1, 1)
DAY = datetime.timedelta(days=1)


def marks(spark, run, start, *hashes):
    rows = [(h, "s", start, start + 90 * DAY, run) for h in hashes]
    return spark.createDataFrame(rows, schemas.SEEN_HASHES)


def hashes(spark, *values):
    return spark.createDataFrame([(h,) for h in values], "content_hash string")


def found(df):
    return sorted((r.content_hash, r.run_id) for r in df.collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_a_lookup_does_not_shuffle_the_state(spark, tmp_path, broadcast):
    root = str(tmp_path)
    for batch in range(5):
        own = marks(spark, f"r{batch}", T0 + batch * DAY, *[f"h{k}" for k in range(batch, 40, 5)])
        seen.save(own, root, batch, alive_at=F.lit(T0), buckets=6, every=3)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        looked = seen.known(hashes(spark, "h3", "h7", "h39", "none", None, "h3"), root, before=5)
        folded = dedupe.drop_seen(hashes(spark, "h1").selectExpr("*", "'x' AS run_id", "timestamp'2026-01-02' AS started_at"), looked)
        plan = plan_of(looked)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # an Exchange stands above the batch's rows only
    for line, text in enumerate(lines := plan.splitlines()):
        if "FileScan" in text:
            depth = re.match(r"[\s:+\-]*", text).end()
            above = []
            for upper in reversed(lines[:line]):
                at = re.match(r"[\s:+\-]*", upper).end()
                if at < depth:
                    above.append(upper)
                    depth = at
            assert not any("Exchange" in a for a in above), plan
            assert "Bucketed: true" in text
    assert plan.count("FileScan") == 2  # the log since the snapshot, and the snapshot
    assert found(looked) == [("h3", "r3"), ("h39", "r4"), ("h7", "r2")]
    assert folded.count() == 1


def test_a_repeat_replaces_its_marks_even_by_none(spark, tmp_path):
    root = str(tmp_path)
    seen.save(marks(spark, "r0", T0, "a", "b", None), root, 0, alive_at=F.lit(T0), buckets=3)
    seen.save(marks(spark, "r1", T0, "c"), root, 1, alive_at=F.lit(T0))
    assert found(seen.read(spark, root, before=9)) == [("a", "r0"), ("b", "r0"), ("c", "r1")]
    seen.save(marks(spark, "r1", T0), root, 1, alive_at=F.lit(T0))
    assert found(seen.read(spark, root, before=9)) == [("a", "r0"), ("b", "r0")]
    assert found(seen.read(spark, root, before=0)) == []


def test_snapshots_keep_the_latest_alive_mark(spark, tmp_path):
    root = str(tmp_path)
    days = [0, 10, 100, 101, 102]
    for batch, day in enumerate(days):
        for _ in range(2 if batch in (2, 4) else 1):
            own = marks(spark, f"r{batch}", T0 + day * DAY, "a" if batch != 1 else "b", f"own{batch}")
            seen.save(own, root, batch, alive_at=F.lit(T0 + day * DAY), buckets=2, every=2)
    # at day 100 those of day 0 have expired and that of day 10 too, as 90 days are over
    assert found(seen.read(spark, root, before=4)) == [("a", "r2"), ("a", "r3"), ("own2", "r2"), ("own3", "r3")]
    assert found(seen.read(spark, root, before=5)) == [("a", "r4"), ("own2", "r2"), ("own3", "r3"), ("own4", "r4")]
    assert found(seen.read(spark, root, before=2)) == [("a", "r0"), ("b", "r1"), ("own0", "r0"), ("own1", "r1")]


def test_point_reads_prune_buckets(spark, tmp_path):
    root = str(tmp_path)
    seen.save(marks(spark, "r0", T0, *[f"h{k}" for k in range(100)]), root, 0, alive_at=F.lit(T0), buckets=8)
    one = seen.marks_of(spark, root, ["h42"], before=1)
    # the plan tells the buckets where it keeps them apart
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = plan_of(one)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 8" in plan
    assert found(one) == [("h42", "r0")] and found(seen.marks_of(spark, root, ["no"], before=1)) == []
    import pyarrow.parquet as pq

    # the filters stand between data and footer: files with them are larger than the column chunks
    file = seen.read(spark, root, before=1).inputFiles()[0].removeprefix("file:").removeprefix("//")
    group = pq.ParquetFile(file).metadata.row_group(0)
    chunks = sum(group.column(k).total_compressed_size for k in range(group.num_columns))
    import os

    assert os.path.getsize(file) > chunks + 100_000


def test_another_session_knows_the_state(spark, tmp_path):
    root = str(tmp_path)
    seen.save(marks(spark, "r0", T0, "a"), root, 0, alive_at=F.lit(T0), buckets=3)
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("gristmill_seen")]:
        spark.sql(f"DROP TABLE {name}")  # the files stay: the tables are external
    assert found(seen.read(spark, root, before=1, buckets=99)) == [("a", "r0")]
    assert found(seen.known(hashes(spark, "a"), root, before=1)) == [("a", "r0")]
