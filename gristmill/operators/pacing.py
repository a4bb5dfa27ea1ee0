"""Token-bucket pacing: effective rates, planned and audited admission times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.operators.breaker import chunk_of

CHUNK_SECONDS = 3600
CHUNK_ROWS = 100_000


def effective_rps(rps: Column, respect_crawl_delay: Column, crawl_delay: Column) -> Column:
    """The site's rate, narrowed to one request per crawl delay where that is respected."""
    narrowed = F.least(rps, F.lit(1.0) / F.nullif(crawl_delay.cast("double"), F.lit(0.0)))
    return F.when(respect_crawl_delay & (crawl_delay > 0), narrowed).otherwise(rps)


def _tie(df: DataFrame) -> Column:
    # orders rows that are equal otherwise by what is in them, so that a repeated task numbers them alike
    return F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind])


def plan_frontier(frontier: DataFrame, *, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Admission offset in seconds of each target, when all of a domain's targets wait at once.

    `frontier(domain, ordinal, rps, burst, ...)`: the first `burst` go at 0, then one per 1/rps.
    The bucket of a domain is sized by its first target's settings. Targets of one ordinal go in an order
    that follows from their content alone. Positions are counted in slices
    of `ordinal`, so that a domain with most of the frontier is not numbered by one task.
    """
    rows = frontier.withColumns({"_chunk": F.floor(F.col("ordinal") / chunk_rows), "_tie": _tie(frontier)})
    # spelled out so that both readers of the slices share one shuffle
    rows = rows.filter("domain is not null and _chunk is not null")
    inside = Window.partitionBy("domain", "_chunk").orderBy("ordinal", "_tie")
    local = rows.withColumn("_pos", F.row_number().over(inside))
    chunks = local.groupBy("domain", "_chunk").agg(
        F.max("_pos").alias("_n"), F.min_by(F.struct("rps", "burst"), F.struct("ordinal", "_tie")).alias("_cfg")
    )
    across = Window.partitionBy("domain").orderBy("_chunk")
    carry = chunks.select(
        "domain",
        "_chunk",
        F.coalesce(F.sum("_n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(
            "_off"
        ),
        F.first("_cfg").over(across).alias("_cfg"),
    )
    position = F.col("_off") + F.col("_pos")
    wait = F.greatest(F.lit(0.0), (position - F.col("_cfg.burst")) / F.col("_cfg.rps"))
    return local.join(carry, ["domain", "_chunk"]).select(
        *frontier.columns, position.alias("position"), wait.alias("admit_after_seconds")
    )


def audit_admissions(requests: DataFrame, *, chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """When each request of `requests(domain, ts, seq, rps, burst)` would have been admitted.

    Adds `delay_seconds` (0 when the bucket had a token) and `violates` (the log shows the request
    before it was due). With T = 1/rps and arrivals a_1, a_2, ... the k-th admission is
    max(a_k, (k-1)T + max_{j<k}(a_j - (j-1)T) - (burst-1)T): a running maximum, taken inside
    time chunks and carried across them by one summary row per chunk.
    """
    first = F.min_by(F.struct("rps", "burst", "ts"), F.struct("ts", "seq", "_tie"))
    tied = requests.withColumn("_tie", _tie(requests))
    buckets = tied.groupBy("domain").agg(first.alias("_bucket"))
    rows = (
        tied.join(buckets, "domain")
        .withColumn("_chunk", chunk_of(F.col("ts"), chunk_seconds))
        .withColumn("_gap", F.lit(1.0) / F.col("_bucket.rps"))
        # seconds since the domain's first request keep the sums exact enough
        .withColumn(
            "_at", (F.unix_micros("ts") - F.unix_micros("_bucket.ts")) / F.lit(1_000_000.0)
        )
    )
    # spelled out so that both readers of the chunks share one shuffle
    rows = rows.filter("domain is not null and _chunk is not null")
    inside = Window.partitionBy("domain", "_chunk").orderBy("ts", "seq", "_tie")
    local = rows.withColumn("_pos", F.row_number().over(inside)).withColumn(
        "_slack", F.col("_at") - (F.col("_pos") - 1) * F.col("_gap")
    )
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = local.withColumn("_peak", F.max("_slack").over(earlier))

    chunks = local.groupBy("domain", "_chunk").agg(
        F.max("_pos").alias("_n"), F.max("_slack").alias("_top"), F.max("_gap").alias("_step")
    )
    before = Window.partitionBy("domain").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        chunks.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_peak_in", F.max(F.col("_top") - F.col("_off") * F.col("_step")).over(before))
        .select("domain", "_chunk", "_off", "_peak_in")
    )
    gap = F.col("_gap")
    peak = F.greatest(F.col("_peak") - F.col("_off") * gap, F.col("_peak_in"))
    due = (F.col("_off") + F.col("_pos") - 1) * gap + peak - (F.col("_bucket.burst") - 1) * gap
    delay = F.greatest(F.lit(0.0), due - F.col("_at"))
    return (
        local.join(carry, ["domain", "_chunk"])
        .withColumn("delay_seconds", F.coalesce(delay, F.lit(0.0)))
        .select(*requests.columns, "delay_seconds", (F.col("delay_seconds") > 1e-9).alias("violates"))
    )
