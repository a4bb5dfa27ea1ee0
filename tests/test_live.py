"""Live breaker: timers without new rows, late rows, restarts, and the batch timeline."""

import datetime
import random

import numpy as np
import pandas as pd
import pytest
from gristmill.operators import breaker
from gristmill.streaming import live

T0 = datetime.datetime(2026, 1, 1)
S = datetime.timedelta(seconds=1)
SCHEMA = "domain string, ts timestamp, seq bigint, failed boolean"


def run(spark, tmp_path, *chunks, **settings):
    """Feed the chunks as one micro-batch and one start of the query each; the events by kind."""
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in chunks:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        live.live_breaker_stream(stream, root, f"{tmp_path}/ck", **settings).awaitTermination()
    found = spark.read.parquet(f"{root}/live").collect()
    return {k: [r for r in found if r.kind == k] for k in ("outcome", "half_open", "late")}


@pytest.mark.parametrize("chunk_seconds", [20, 3600])
def test_events_equal_the_batch_timeline(spark, tmp_path, chunk_seconds):
    rng = random.Random(chunk_seconds)
    rows, at = [], 0
    for seq in range(300):
        at += rng.choice([0, 1, 5, 40, 70])
        rows.append((rng.choice("aab"), T0 + at * S, seq, rng.random() < 0.8))
    got = run(spark, tmp_path, rows[:100], rows[100:200], rows[200:], fail_max=3, chunk_seconds=chunk_seconds)
    want = breaker.breaker_timeline(spark.createDataFrame(rows, SCHEMA), fail_max=3).collect()
    names = ["domain", "ts", "seq", "failed", "streak", "state_before", "open_after", "opened_at"]
    assert sorted(str([r[c] for c in names]) for r in got["outcome"]) == sorted(str([r[c] for c in names]) for r in want)
    due = []
    for d in "ab":
        own = sorted((r for r in want if r.domain == d), key=lambda r: (r.ts, r.seq))
        for r, after in zip(own, [*own[1:], None], strict=True):
            if r.open_after and (after is None and r.ts + 60 * S < rows[-1][1] or after and after.ts >= r.ts + 60 * S):
                due.append((d, r.ts + 60 * S))
    assert sorted((r.domain, r.ts) for r in got["half_open"]) == sorted(due)
    assert not got["late"]


def test_an_open_breaker_turns_half_open_without_a_row(spark, tmp_path):
    opened = [("a", T0 + k * S, k, True) for k in range(3)]
    got = run(spark, tmp_path, opened, [("b", T0 + 30 * S, 0, False)], fail_max=3)
    assert not got["half_open"]
    # only the clock of another domain goes on
    got = run(spark, tmp_path, [("b", T0 + 500 * S, 1, False)], fail_max=3)
    assert [(r.domain, r.ts) for r in got["half_open"]] == [("a", T0 + 62 * S)]
    # the trial meets a half-open breaker, which is not reported twice
    got = run(spark, tmp_path, [("a", T0 + 900 * S, 9, False)], [("b", T0 + 2000 * S, 2, False)], fail_max=3)
    assert len(got["half_open"]) == 1
    assert [r.state_before for r in got["outcome"] if r.seq == 9] == ["half_open"]


def test_late_rows_are_counted_and_rewind_nothing(spark, tmp_path):
    first = [("a", T0 + k * S, k, True) for k in range(4)]
    late = [("a", T0 + 1 * S, 77, False), ("a", T0 + 3 * S, 3, False), ("a", T0 + 3 * S, 4, True), ("c", T0, 0, True)]
    got = run(spark, tmp_path, first, late, fail_max=3)
    assert [(r.domain, r.late) for r in got["late"]] == [("a", 2)]
    assert [(r.seq, r.streak) for r in got["outcome"] if r.domain == "a" and r.seq > 3] == [(4, 5)]
    assert any(r.domain == "c" for r in got["outcome"])


def test_nulls_long_runs_and_nothing(spark, tmp_path):
    rows = [(None, T0, 1, True), ("a", None, 2, True), ("a", T0, 3, None)]
    assert not any(run(spark, tmp_path, rows).values())
    many = [("a", T0, k, True) for k in range(25_000)]
    got = run(spark, tmp_path, many, fail_max=3)
    assert sorted(r.streak for r in got["outcome"]) == list(range(1, 25_001))


def test_a_step_keeps_the_sessions_settings(spark, tmp_path):
    before = spark.conf.get(live.PROVIDER, None)
    run(spark, tmp_path, [("a", T0, 1, True)])
    assert spark.conf.get(live.PROVIDER, None) == before


def test_a_domain_goes_out_in_parts():
    """Of a domain's rows in a micro-batch neither all runs nor all events are Python objects at once."""

    class Place:
        def exists(self):
            return False

        def update(self, state):
            self.state = state

    class Handle:
        def registerTimer(self, at):
            self.timer = at

    place, handle = Place(), Handle()
    one = live.Breaker(3, 60_000_000)
    one.place, one.handle = place, handle
    n = 50_000
    ats = np.arange(n).reshape(-1, 2) * 1_000_000
    order = np.random.default_rng(3).permutation(len(ats))
    rows = pd.DataFrame({"failed": order % 2 == 0, "ats": list(ats[order]), "seqs": list(ats[order])})
    out = list(one.handleInputRows(("a",), iter([rows[:9000], rows[9000:9000], rows[9000:]]), None))
    assert len(out) >= 4 and max(len(part) for part in out) <= live.RUN_ROWS
    told = pd.concat(out)
    assert [x for run in told["ats"] for x in run] == ats.ravel().tolist()
    assert told["failed"].tolist() == [k % 2 == 0 for k in range(len(ats))]
    assert place.state == (0, ats[-1, 1], ats[-1, 1], 0, True)
