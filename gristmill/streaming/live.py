"""Live circuit breakers: keyed state with event-time timers.

Unlike `jobs.breaker_stream`, which derives the state at some time from a state table, this stream
itself reports when an open breaker turns half-open: a timer fires once the watermark has passed the
time, whether or not an outcome of that domain ever arrives again.

A domain's outcomes need one order, but not row by row in one task: each micro-batch is first dealt
by (domain, time chunk), sorted and joined to runs of equal outcomes, at most `RUN_ROWS` in each. The
keyed state sees runs; their rows are told apart again afterwards, by column functions. State is one
row per domain, in RocksDB.

Times are compared in microseconds, timers fire by milliseconds (rounded up). Rows at or before
their domain's last processed place rewind nothing: they are counted as late. Rows with a null
domain, time or outcome touch nothing. The watermark drops no rows, as it only drives the timers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from gristmill import fixed_values as V
from gristmill.operators.breaker import CHUNK_SECONDS, chunk_of

RUN_ROWS = 10_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

RUNS = "domain string, failed boolean, ats array<bigint>, seqs array<bigint>"
STATE = "streak bigint, at bigint, seq bigint, due bigint, seen boolean"
EVENTS = f"kind string, {RUNS}, streak bigint, at bigint, late bigint"


def to_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Outcomes (domain, chunk, at, seq, failed) of whole chunks as runs, in order within a domain."""
    held = list(batches)
    if not any(b.num_rows for b in held):
        return
    rows = pa.Table.from_batches(held).sort_by([(c, "ascending") for c in ("domain", "at", "seq")])
    domain = rows["domain"].combine_chunks().dictionary_encode().indices.to_numpy()
    chunk, failed = rows["chunk"].to_numpy(), rows["failed"].to_numpy()
    new = np.append(True, (np.diff(domain) != 0) | (np.diff(chunk) != 0) | (failed[1:] != failed[:-1]))
    starts = np.flatnonzero(new)
    place = np.arange(len(new)) - np.repeat(starts, np.diff(np.append(starts, len(new))))
    starts = np.flatnonzero(place % RUN_ROWS == 0)
    offsets = pa.array(np.append(starts, len(new)), pa.int32())
    first = rows.take(pa.array(starts))
    columns = [first["domain"].combine_chunks(), first["failed"].combine_chunks()]
    columns += [pa.ListArray.from_arrays(offsets, rows[c].combine_chunks()) for c in ("at", "seq")]
    yield pa.RecordBatch.from_arrays(columns, names=["domain", "failed", "ats", "seqs"])


class Breaker(StatefulProcessor):
    """One domain's breaker: streak, last place, and when the open breaker turns half-open."""

    def __init__(self, fail_max: int, reset_micros: int) -> None:
        self.fail_max, self.reset = fail_max, reset_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.place.get() if self.place.exists() else (0, 0, 0, 0, False)
        streak, at, seq, due, seen = known
        timer, late, out, held = due, 0, [], 0
        for failed, ats, seqs in _in_order(rows):
            if seen:
                fresh = (ats > at) | ((ats == at) & (seqs > seq))
                late += int(len(fresh) - fresh.sum())
                ats, seqs = ats[fresh], seqs[fresh]
                if not len(ats):
                    continue
            if due and ats[0] >= due:
                out.append(self._half_open(key, due))
            out.append(("outcome", key[0], bool(failed), ats.tolist(), seqs.tolist(), streak, at if seen else None, None))
            if failed:
                # the breaker is open behind every row from the one that fills the streak on
                waits = np.flatnonzero(np.diff(ats) >= self.reset)
                out += [
                    self._half_open(key, int(ats[k]) + self.reset)
                    for k in waits.tolist()
                    if streak + k + 1 >= self.fail_max
                ]
                streak += len(ats)
            else:
                streak = 0
            at, seq, seen = int(ats[-1]), int(seqs[-1]), True
            due = at + self.reset if streak >= self.fail_max else 0
            held += len(ats)
            if held >= RUN_ROWS:
                yield _frame(out)
                out, held = [], 0
        if timer != due:
            if timer:
                self.handle.deleteTimer(_millis(timer))
            if due:
                self.handle.registerTimer(_millis(due))
        self.place.update((streak, at, seq, due, seen))
        if late:
            out.append(("late", key[0], None, None, None, None, None, late))
        yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        streak, at, seq, due, seen = self.place.get()
        if due and _millis(due) <= expiredTimerInfo.getExpiryTimeInMs():
            self.place.update((streak, at, seq, 0, seen))
            yield _frame([self._half_open(key, due)])
        else:
            yield _frame([])

    def _half_open(self, key: tuple, due: int) -> tuple:
        return ("half_open", key[0], None, None, None, None, due, None)

    def close(self) -> None:
        pass


def _in_order(parts: Iterator[pd.DataFrame]) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
    """A domain's runs by time and place. Of all its rows only two numbers each are held."""
    failed, sizes, ats, seqs = [], [], [], []
    for part in parts:
        if len(part):
            failed.append(part["failed"].to_numpy(dtype=bool))
            sizes.append(np.array([len(x) for x in part["ats"]], dtype=np.int64))
            for whole, column in ((ats, "ats"), (seqs, "seqs")):
                whole.append(np.concatenate([np.asarray(x, dtype=np.int64) for x in part[column]]))
    if not sizes:
        return
    failed, sizes, ats, seqs = (np.concatenate(x) for x in (failed, sizes, ats, seqs))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    for k in np.lexsort((seqs[starts], ats[starts])):
        run = slice(starts[k], ends[k])
        yield failed[k], ats[run], seqs[run]


def _millis(micros: int) -> int:
    return -(-micros // 1000)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    columns = ["kind", "domain", "failed", "ats", "seqs", "streak", "at", "late"]
    out = pd.DataFrame(rows, columns=columns, dtype=object)
    return out.astype({c: "Int64" for c in ("streak", "at", "late")} | {"failed": "boolean"})


def live_breaker(
    results: DataFrame,
    *,
    fail_max: int = V.BREAKER_FAIL_MAX,
    reset_seconds: float = V.BREAKER_RESET_SECONDS,
    delay: str = "0 seconds",
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Events of a stream of `results(domain, ts, seq, failed)`, as a stream with columns domain,
    kind, ts, seq, failed, streak, state_before, open_after, opened_at and late.

    `outcome`: a row of `breaker_timeline`. `half_open`: an open breaker has waited `reset_seconds` at
    `ts`; reported once, by the timer or ahead of a later outcome of that domain. `late`: the number of
    rows left aside. The watermark follows the newest `ts` by `delay`.
    """
    reset = int(reset_seconds * 1e6)
    rows = results.withWatermark("ts", delay).where(
        F.col("domain").isNotNull() & F.col("ts").isNotNull() & F.col("failed").isNotNull()
    )
    rows = rows.select(
        "domain", chunk_of(F.col("ts"), chunk_seconds).cast("long").alias("chunk"),
        F.unix_micros("ts").alias("at"), F.col("seq").cast("long").alias("seq"), "failed",
    )
    runs = rows.repartition("domain", "chunk").mapInArrow(to_runs, RUNS)
    events = runs.groupBy("domain").transformWithStateInPandas(
        Breaker(fail_max, reset), EVENTS, outputMode="Append", timeMode="EventTime"
    )
    step = F.posexplode_outer(F.arrays_zip("ats", "seqs")).alias("k", "x")
    told = events.select("kind", "domain", "failed", "streak", "late", "ats", F.col("at").alias("before"), step)
    k, at = F.col("k"), F.col("x.ats")
    before_at = F.when(k == 0, F.col("before")).otherwise(F.get("ats", k - 1))
    before = F.when(k == 0, F.col("streak")).when(F.col("failed"), F.col("streak") + k).otherwise(0)
    streak = F.when(F.col("failed"), F.col("streak") + k + 1).otherwise(0)
    outcome = F.col("kind") == "outcome"
    state = (
        F.when(before < fail_max, "closed").when(at - before_at >= reset, "half_open").otherwise("open")
    )
    open_after = F.col("failed") & (streak >= fail_max)
    ts = F.timestamp_micros(F.when(outcome, at).otherwise(F.col("before")))
    return told.select(
        "domain", "kind", ts.alias("ts"), F.col("x.seqs").alias("seq"), "failed",
        F.when(outcome, streak).alias("streak"), F.when(outcome, state).alias("state_before"),
        F.when(outcome, open_after).alias("open_after"),
        F.when(outcome & open_after, F.timestamp_micros(at)).alias("opened_at"), "late",
    )


def live_breaker_stream(
    results: DataFrame, root: str, checkpoint: str, *, trigger: dict | None = None, **settings
) -> StreamingQuery:
    """Write the events of `live_breaker` to `root/live`; state is kept in RocksDB."""
    conf = results.sparkSession.conf
    earlier = conf.get(PROVIDER, None)
    conf.set(PROVIDER, ROCKSDB)  # a query keeps the setting it was started under
    try:
        writer = live_breaker(results, **settings).writeStream.format("parquet")
        writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start(f"{root}/live")
    finally:
        if earlier is None:
            conf.unset(PROVIDER)
        else:
            conf.set(PROVIDER, earlier)
