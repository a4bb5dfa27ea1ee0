"""Streaming jobs. Each is `foreachBatch` over the batch operators plus a state log: a micro-batch
sees the state of the batches before it and replaces its own partition when it is tried again, so
results are exactly-once. Hot keys are handled as in batch, since the operators are the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from gristmill import fixed_values as V
from gristmill.operators import dedupe
from gristmill.operators.breaker import breaker_timeline
from gristmill.operators.extract import EXTRACTORS, extract_sites, page_errors_of, records_of, rejects_of
from gristmill.plans.site_run import run_batch
from gristmill.session import cut
from gristmill.sources import seen, zones
from gristmill.sources.registry import site_errors


def _start(
    stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def parse_stream(
    pages: DataFrame, runs: DataFrame, registry: DataFrame, root: str, checkpoint: str, *, trigger=None
) -> StreamingQuery:
    """Parse arriving raw pages into `records`, `rejects`, `page_errors` and `site_errors` under `root`.

    Pages of a site or run that is not known yet are counted in `site_errors`, not dropped unseen."""

    def step(arrived: DataFrame, batch: int) -> None:
        extracted = cut(extract_sites(arrived, registry), "stream-extracted")
        zones.append_state(records_of(extracted, runs), f"{root}/records", batch)
        zones.append_state(rejects_of(extracted), f"{root}/rejects", batch)
        zones.append_state(page_errors_of(extracted), f"{root}/page_errors", batch)
        unknown = site_errors(arrived, runs, registry, EXTRACTORS).where("pages > 0")
        zones.append_state(unknown, f"{root}/site_errors", batch)

    return _start(pages, step, checkpoint, trigger)


def dedupe_stream(
    records: DataFrame,
    root: str,
    checkpoint: str,
    *,
    ttl_days: int = V.DEDUPE_TTL_DAYS,
    now: str = "started_at",
    order: tuple[str, ...] = ("page_ord", "element_ord"),
    trigger=None,
) -> StreamingQuery:
    """Keep records whose hash is not alive, with the exact fixed expiry; written to `root/kept`."""

    def step(arrived: DataFrame, batch: int) -> None:
        rows = cut(arrived, "stream-records")
        known = seen.known(rows, root, before=batch)
        kept = dedupe.dedupe_history(rows, ttl_days=ttl_days, now=now, order=order, seen=known)
        kept = cut(kept, "stream-kept")
        zones.append_state(kept, f"{root}/kept", batch)
        marks = dedupe.seen_rows(kept, now=now, ttl_days=ttl_days)
        newest = rows.agg(F.max(now)).first()[0]
        seen.save(marks, root, batch, alive_at=F.lit(newest).cast("timestamp"))

    return _start(records, step, checkpoint, trigger)


BREAKER_STATE = "domain string, streak bigint, last_ts timestamp, last_seq bigint"


def breaker_stream(
    results: DataFrame,
    root: str,
    checkpoint: str,
    *,
    fail_max: int = V.BREAKER_FAIL_MAX,
    reset_seconds: float = V.BREAKER_RESET_SECONDS,
    trigger=None,
) -> StreamingQuery:
    """Breaker timeline of arriving `results(domain, ts, seq, failed)`, carried over micro-batches.

    Rows at or before a domain's last processed place are late: they are counted under
    `root/late` and rewind nothing. The timeline goes to `root/timeline`.
    """

    def step(arrived: DataFrame, batch: int) -> None:
        spark = arrived.sparkSession
        rows = cut(arrived.filter(F.col("failed").isNotNull()), "stream-results")
        known = read_breaker_state(spark, root, before=batch)
        state = known.join(rows.select("domain").distinct(), "domain", "left_semi")
        placed = rows.join(state, "domain", "left").withColumn(
            "_late", F.struct("ts", "seq") <= F.struct("last_ts", "last_seq")
        )
        late = placed.filter("_late").groupBy("domain").agg(F.count("*").alias("late"))
        zones.append_state(late, f"{root}/late", batch)
        on_time = placed.filter("_late is null or not _late").select(*results.columns)
        timeline = breaker_timeline(
            on_time, fail_max=fail_max, reset_seconds=reset_seconds, carried=state
        )
        timeline = cut(timeline, "stream-timeline")
        zones.append_state(timeline, f"{root}/timeline", batch)
        place = F.struct("ts", "seq")
        last = timeline.groupBy("domain").agg(
            F.max_by("streak", place).cast("long").alias("streak"),
            F.max(place).alias("_place"),
        )
        changed = last.select(
            "domain",
            "streak",
            F.col("_place.ts").alias("last_ts"),
            F.col("_place.seq").alias("last_seq"),
        )
        zones.save_state(changed, f"{root}/state/breaker", BREAKER_STATE, "domain", batch)

    return _start(results, step, checkpoint, trigger)


def breaker_state_at(
    state: DataFrame,
    now,
    *,
    fail_max: int = V.BREAKER_FAIL_MAX,
    reset_seconds: float = V.BREAKER_RESET_SECONDS,
) -> DataFrame:
    """Live state of each domain at `now`: an open breaker turns half-open by time alone."""
    waited = F.unix_micros(now) - F.unix_micros("last_ts") >= F.lit(int(reset_seconds * 1e6))
    live = F.when(F.col("streak") < fail_max, "closed").when(waited, "half_open").otherwise("open")
    return state.withColumn("state", live)


def read_breaker_state(spark: SparkSession, root: str, *, before: int) -> DataFrame:
    """Last streak and place of each domain, as of the batches before `before`."""
    return zones.load_state(
        spark, f"{root}/state/breaker", BREAKER_STATE, "domain", before=before
    )


def gate_stream(
    pages: DataFrame,
    registry: DataFrame,
    root: str,
    checkpoint: str,
    *,
    scraper_version: str,
    backend: str = "local",
    trigger=None,
) -> StreamingQuery:
    """Run every micro-batch of raw pages through the gate, as one run per site named after it."""

    def step(arrived: DataFrame, batch: int) -> None:
        spark = arrived.sparkSession
        rows = cut(arrived.withColumn("run_id", F.lit(f"stream-{batch:010d}")), "stream-pages")
        runs = rows.groupBy("run_id", "site_id").agg(F.min("fetched_at").alias("started_at"))
        runs = runs.withColumns(
            {"scraper_version": F.lit(scraper_version), "backend": F.lit(backend)}
        )
        if not rows.isEmpty():
            run_batch(spark, rows, runs, registry, root, batch=batch)

    return _start(pages, step, checkpoint, trigger)


