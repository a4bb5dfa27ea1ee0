"""Circuit breaker of each domain, replayed from fetch outcomes.

A domain's outcomes must be read in order, but never by one task: they are cut into chunks of
time, each chunk is windowed by itself, and one summary row per chunk carries position and last
success across. A domain with a third of all rows thus spreads over as many tasks as it has chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill import fixed_values as V

CHUNK_SECONDS = 3600


def chunk_of(ts: Column, seconds: int) -> Column:
    """Number of the time slice that `ts` falls into."""
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000))


def breaker_timeline(
    results: DataFrame,
    *,
    fail_max: int = V.BREAKER_FAIL_MAX,
    reset_seconds: float = V.BREAKER_RESET_SECONDS,
    chunk_seconds: int = CHUNK_SECONDS,
    carried: DataFrame | None = None,
) -> DataFrame:
    """Breaker state around each outcome of `results(domain, ts, seq, failed)`.

    Adds `streak` (consecutive failures up to this row), `state_before` (`closed`, `open` or
    `half_open`, as met by this row), `open_after` and `opened_at`. Rows with null `failed` (robots)
    touch nothing and are dropped. The breaker is open once the streak reaches `fail_max`; a streak
    only ends with a success, so a failed trial reopens by itself. `carried(domain, streak,
    last_ts)` is the state left by earlier outcomes.
    """
    rows = results.withColumn("_chunk", chunk_of(F.col("ts"), chunk_seconds))
    # Spelled out so that both readers of the chunks ask for the same rows and share one shuffle.
    rows = rows.filter("failed is not null and domain is not null and _chunk is not null")
    inside = Window.partitionBy("domain", "_chunk").orderBy("ts", "seq")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns(
        {"_pos": F.row_number().over(inside), "_prev_ts": F.lag("ts").over(inside)}
    ).withColumn("_last_ok", F.max(F.when(~F.col("failed"), F.col("_pos"))).over(so_far))
    local = local.withColumn("_prev_ok", F.lag("_last_ok").over(inside))

    chunks = local.groupBy("domain", "_chunk").agg(
        F.max("_pos").alias("_n"), F.max("_last_ok").alias("_ok"), F.max("ts").alias("_end")
    )
    across = Window.partitionBy("domain").orderBy("_chunk")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        chunks.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_ok_in", F.max(F.col("_off") + F.col("_ok")).over(before))
        .withColumn("_end_in", F.lag("_end").over(across))
        .select("domain", "_chunk", "_off", "_ok_in", "_end_in")
    )
    if carried is not None:
        # The streak brought along counts as failures before position 1.
        start = carried.select(
            "domain", F.col("streak").alias("_streak_in"), F.col("last_ts").alias("_start_ts")
        )
        carry = carry.join(start, "domain", "left")
    else:
        carry = carry.withColumns(
            {"_streak_in": F.lit(0), "_start_ts": F.lit(None).cast("timestamp")}
        )
    no_success = -F.coalesce("_streak_in", F.lit(0))
    pos = F.col("_off") + F.col("_pos")
    streak = pos - F.coalesce(F.col("_off") + F.col("_last_ok"), F.col("_ok_in"), no_success)
    prev_streak = pos - 1 - F.coalesce(F.col("_off") + F.col("_prev_ok"), F.col("_ok_in"), no_success)
    prev_ts = F.coalesce("_prev_ts", "_end_in", "_start_ts")
    waited = (F.unix_micros("ts") - F.unix_micros(prev_ts)) >= F.lit(int(reset_seconds * 1e6))
    open_after = F.col("failed") & (streak >= fail_max)
    return (
        local.join(carry, ["domain", "_chunk"])
        .select(
            *results.columns,
            streak.alias("streak"),
            F.when(prev_streak < fail_max, "closed")
            .when(waited, "half_open")
            .otherwise("open")
            .alias("state_before"),
            open_after.alias("open_after"),
            F.when(open_after, F.col("ts")).alias("opened_at"),
        )
    )


def domain_health(results: DataFrame, *, fail_max: int = V.BREAKER_FAIL_MAX) -> DataFrame:
    """Last success, failures since then and whether the breaker is open, per domain.

    Two pre-aggregated passes and no sort: failures are counted after the last success.
    """
    results = results.filter(F.col("failed").isNotNull())
    place = F.struct("ts", "seq")
    last = results.groupBy("domain").agg(F.max(F.when(~F.col("failed"), place)).alias("_ok"))
    since = F.col("failed") & (F.col("_ok").isNull() | (place > F.col("_ok")))
    return (
        results.join(last, "domain")
        .groupBy("domain")
        .agg(
            F.max("_ok.ts").alias("last_success_at"),
            F.sum(since.cast("long")).alias("consecutive_failures"),
        )
        .withColumn("breaker_open", F.col("consecutive_failures") >= fail_max)
    )
