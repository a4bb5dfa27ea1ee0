"""Dedupe: order, expiry, state, history."""

import datetime
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gristmill import schemas
from gristmill.operators import dedupe
from gristmill.session import cut

T0 = datetime.datetime(2026, 1, 1)
DAY = datetime.timedelta(days=1)
SCHEMA = (
    "content_hash string, site_id string, run_id string, started_at timestamp, "
    "page_ord int, element_ord int"
)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_first_in_document_order_wins_over_all_sites(spark):
    rows = [
        ("h", "b", "r", T0, 2, 0),
        ("h", "a", "r", T0, 1, 5),
        ("h", "c", "r", T0, 1, 4),
        ("g", "a", "r", T0, 9, 9),
    ]
    kept = dedupe.dedupe_batch(frame(spark, rows)).orderBy("content_hash").collect()
    assert [(r.content_hash, r.site_id) for r in kept] == [("g", "a"), ("h", "c")]


def test_hot_hash_is_cut_down_before_the_shuffle(spark):
    kept = dedupe.dedupe_batch(frame(spark, [("h", "a", "r", T0, 0, 0)]))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:], plan  # below the exchange = before it


def seen(spark, at, hash_="h", run="old", ttl=90):
    kept = frame(spark, [(hash_, "a", run, at, 0, 0)])
    return dedupe.seen_rows(kept, ttl_days=ttl)


@pytest.mark.parametrize(
    "after, kept", [(1 * DAY, 0), (90 * DAY - datetime.timedelta(microseconds=1), 0), (90 * DAY, 1)]
)
def test_expiry_is_strict(spark, after, kept):
    records = frame(spark, [("h", "b", "new", T0 + after, 0, 0)])
    assert dedupe.drop_seen(records, seen(spark, T0)).count() == kept
    assert dedupe.drop_seen(records, seen(spark, T0), small_batch=True).count() == kept


def test_zero_ttl_never_repeats(spark):
    records = frame(spark, [("h", "b", "new", T0, 0, 0)])
    assert dedupe.drop_seen(records, seen(spark, T0, ttl=0)).count() == 1
    twice = frame(spark, [("h", "b", "r", T0, 0, 0), ("h", "b", "r", T0, 0, 1)])
    assert dedupe.dedupe_history(twice, ttl_days=0).count() == 2


def test_a_repeated_run_ignores_its_own_marks(spark):
    records = frame(spark, [("h", "a", "same", T0, 0, 0)])
    assert dedupe.drop_seen(records, seen(spark, T0, run="same")).count() == 1


def test_mark_seen_overwrites_everything(spark):
    first, second = seen(spark, T0), seen(spark, T0 + 100 * DAY, run="new")
    (row,) = dedupe.mark_seen(first, second).collect()
    assert row.run_id == "new" and row.first_seen == T0 + 100 * DAY
    assert row.expires_at == T0 + 190 * DAY
    alive = dedupe.mark_seen(first, seen(spark, T0, "g", ttl=200), alive_at="2026-05-01")
    assert [r.content_hash for r in alive.collect()] == ["g"]


def by_hand(rows, ttl, state):
    free = dict(state)
    kept = []
    for row in sorted(rows, key=lambda r: (r[3], r[4], r[5])):
        if row[0] in free and row[3] < free[row[0]]:
            continue
        free[row[0]] = row[3] + ttl
        kept.append(row)
    return sorted(kept)


@pytest.mark.parametrize("fold_limit", [10**6, 3])
@pytest.mark.parametrize("with_state", [False, True])
def test_history_equals_one_run_after_another(spark, fold_limit, with_state):
    rng = random.Random(7)
    rows = [
        (rng.choice("aaaaabcd"), "s", f"r{t}", T0 + t * DAY / 4, i, 0)
        for i, t in enumerate(rng.choices(range(80), k=400))
    ]
    state = {"a": T0 + 5 * DAY, "c": T0 + DAY / 2, "z": T0} if with_state else {}
    expected = by_hand(rows, 2 * DAY, state)
    table = None
    if with_state:
        marks = [(h, "s", e - 2 * DAY, e, "old") for h, e in state.items()]
        table = spark.createDataFrame(marks, schemas.SEEN_HASHES)
    kept = dedupe.dedupe_history(
        frame(spark, rows), ttl_days=2, seen=table, fold_limit=fold_limit
    )
    assert sorted(tuple(r) for r in kept.collect()) == expected


def test_history_shuffles_the_records_once(spark):
    rows = frame(spark, [("h", "a", f"r{i}", T0 + i * DAY, 0, 0) for i in range(5)])
    kept = dedupe.dedupe_history(rows.withColumn("wide", F.lit("x")), ttl_days=2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = kept.select("*")
        plan = again._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("content_hash" in line and "_at" in line for line in wide) <= 3, plan


def test_a_million_times_of_one_hash(spark):
    """Chains of about as many links as there are seconds: rounds grow with their logarithm."""
    n = 1_000_000
    at = F.pmod(F.xxhash64("id"), F.lit(n * 700_000))
    rows = spark.range(n).select(
        F.when(F.col("id") % 1000 == 0, F.concat(F.lit("h"), F.col("id") % 3000)).otherwise(F.lit("hot")).alias("content_hash"),
        F.timestamp_micros(at).alias("started_at"), F.lit(0).alias("page_ord"), F.lit(0).alias("element_ord"),
    )
    kept = dedupe.dedupe_history(cut(rows, "million"), ttl_days=1 / 86_400)
    found = kept.groupBy("content_hash").agg(F.count("*").alias("n"), F.sum(F.unix_micros("started_at")).alias("sum"))
    got = {r.content_hash: (r.n, r.sum) for r in found.collect()}
    want = {}
    for name, times in rows.select("content_hash", F.unix_micros("started_at").alias("t")).toPandas().groupby("content_hash")["t"]:
        free, chain = -1, []
        for t in sorted(set(times)):
            if t >= free:
                chain.append(t)
                free = t + 1_000_000
        want[name] = (len(chain), sum(chain))
    assert got == want and got["hot"][0] > 300_000


def test_crowded_slices_and_lookups_over_gaps(spark):
    """All times but a few in one slice, and free times far behind."""
    base = datetime.datetime(2026, 1, 1)
    near = [base + datetime.timedelta(microseconds=k) for k in range(300)]
    far = [base + datetime.timedelta(days=k) for k in (5, 6, 50, 51, 52, 400)]
    rows = [("a", t) for t in near + far] + [("b", t) for t in near]
    df = spark.createDataFrame([(h, t, 0, 0) for h, t in rows], "content_hash string, started_at timestamp, page_ord int, element_ord int")
    for days in (0.0000000002, 3):
        one = dedupe.dedupe_history(df, ttl_days=days, fold_limit=5)
        other = dedupe.dedupe_history(df, ttl_days=days, fold_limit=10**6)
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_many_small_slices_take_no_python_call_each(spark):
    """Slices are folded as lists, many to a batch, and no batch of them gives out very many rows at once."""
    rows = [(h, T0 + k * DAY, 0, 0) for h in "abc" for k in range(40)]
    df = spark.createDataFrame(rows, "content_hash string, started_at timestamp, page_ord int, element_ord int")
    kept = dedupe.dedupe_history(df, ttl_days=2, fold_limit=5)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and "MapInArrow" in plan
    assert kept.count() == 60

    sizes = [7, 0, 60_000, 30_000, 20_000, 250_000, 1, 1]
    lists = [np.arange(n) for n in sizes]
    batch = pa.RecordBatch.from_pydict({"ats": pa.array(lists, pa.list_(pa.int64()))}).slice(1)
    got = [[len(x) for x in dedupe._lists(part)] for part in dedupe._parts(iter([batch, batch.slice(0, 0)]))]
    assert got == [[0, 60_000, 30_000], [20_000], [250_000], [1, 1]]
