"""Batch quality: four scores, thresholds and the gate, for all (site, run) batches at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import fixed_values as V
from gristmill import schemas
from gristmill.session import small_table

BATCH = ("site_id", "run_id")
STATUSES = ("pass", "warn", "fail")  # from best to worst
DIMENSIONS = ("completeness", "uniqueness", "validity", "consistency")


def default_profiles(spark: SparkSession) -> DataFrame:
    """The registered threshold profiles as a table."""
    rows = [(name, *row) for name, profile in V.PROFILES.items() for row in profile]
    return small_table(spark, rows, schemas.DQ_PROFILES)


def bad_title() -> Column:
    return F.coalesce(F.length("title") < 1, F.lit(True))


def bad_price() -> Column:
    # NaN compares greater than any number, so it is named.
    price = F.col("price").cast("double")
    return F.coalesce(~(price > 0) | F.isnan(price), F.lit(False))


def bad_currency() -> Column:
    return F.coalesce(F.length("currency") != 3, F.lit(False))


def failed_checks() -> Column:
    """Names of the validity checks a row fails, in order."""
    return F.array_compact(
        F.array(
            F.when(bad_title(), "title"),
            F.when(bad_price(), "price"),
            F.when(bad_currency(), "currency"),
        )
    )


def failure_cases(records: DataFrame) -> DataFrame:
    """One row per failed check of each record."""
    return records.withColumn("failed_check", F.explode(failed_checks()))


def batch_counts(records: DataFrame, keys: Sequence[str] = BATCH) -> DataFrame:
    """Everything the four scores need, from one aggregate.

    Pre-aggregated by (batch, hash) and then by batch, so a batch that holds most rows is still
    counted in parallel.
    """
    invalid = (bad_title() | bad_price() | bad_currency()).cast("long")
    consistent = (F.col("price").isNull() == F.col("currency").isNull()).cast("long")
    return records.groupBy(*keys).agg(
        F.count("*").alias("total_records"),
        F.avg("completeness_score").alias("completeness"),
        F.count_distinct("content_hash").alias("unique_hashes"),
        F.sum(invalid).alias("invalid_records"),
        F.sum(consistent).alias("consistent_records"),
    )


def score_dimensions(
    records: DataFrame, batches: DataFrame, profiles: DataFrame, *, keys: Sequence[str] = BATCH
) -> DataFrame:
    """One row per expected batch and dimension: score, thresholds, status and detail.

    `batches` lists the expected batches with their `dq_profile`: a batch without records scores
    0.0 everywhere, where a plain group-by would lose it. An unknown profile is an error.
    """
    counted = batches.select(*keys, "dq_profile").join(batch_counts(records, keys), list(keys), "left")
    n = F.coalesce("total_records", F.lit(0))
    some = n > 0
    unique = F.coalesce("unique_hashes", F.lit(0))
    scores = {
        "completeness": (F.col("completeness"), F.format_string(V.DETAIL_COMPLETENESS, n)),
        "uniqueness": (unique / n, F.format_string(V.DETAIL_UNIQUENESS, unique, n)),
        "validity": (
            1 - F.col("invalid_records") / n,
            F.when(some, F.format_string(V.DETAIL_VALIDITY, F.col("invalid_records"), n)).otherwise(
                V.DETAIL_VALIDITY_EMPTY
            ),
        ),
        "consistency": (F.col("consistent_records") / n, F.lit(V.DETAIL_CONSISTENCY)),
    }
    long = counted.select(
        *keys,
        "dq_profile",
        n.alias("total_records"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("dimension"),
                        F.when(some, score).otherwise(0.0).alias("score"),
                        detail.alias("detail"),
                    )
                    for name, (score, detail) in scores.items()
                ]
            )
        ),
    )
    limits = profiles.withColumnRenamed("profile", "dq_profile")
    known = F.coalesce(
        "fail_threshold",
        F.raise_error(F.concat(F.lit("unknown dq_profile: "), F.col("dq_profile"))).cast("double"),
    )
    fail, warn = known, F.col("warn_threshold")
    status = F.when(F.col("score") < fail, "fail").when(F.col("score") < warn, "warn")
    return long.join(limits, ["dq_profile", "dimension"], "left").select(
        *keys,
        "total_records",
        "dimension",
        "score",
        "warn_threshold",
        "fail_threshold",
        status.otherwise("pass").alias("status"),
        "detail",
    )


def gate(dimensions: DataFrame, keys: Sequence[str] = BATCH) -> DataFrame:
    """One row per batch with the worst status of its dimensions."""
    return dimensions.groupBy(*keys).agg(
        F.max("total_records").alias("total_records"), _worst_status().alias("gate_status")
    )


def _worst_status() -> Column:
    statuses = F.array(*[F.lit(s) for s in STATUSES])
    return F.element_at(statuses, F.max(F.array_position(statuses, F.col("status"))).cast("int"))


def evaluate(
    records: DataFrame,
    batches: DataFrame,
    profiles: DataFrame,
    *,
    keys: Sequence[str] = BATCH,
    generated_at: Column | None = None,
) -> DataFrame:
    """The quality report: one row per batch with its dimensions (four, in order) and gate."""
    dimensions = score_dimensions(records, batches, profiles, keys=keys)
    return report(dimensions, keys=keys, generated_at=generated_at)


def report(
    dimensions: DataFrame, *, keys: Sequence[str] = BATCH, generated_at: Column | None = None
) -> DataFrame:
    """Scored dimensions folded to one row per batch."""
    order = F.array_position(F.array(*[F.lit(d) for d in DIMENSIONS]), F.col("dimension"))
    row = F.struct(
        order.alias("position"),
        "dimension",
        "score",
        "warn_threshold",
        "fail_threshold",
        "status",
        "detail",
    )
    return (
        dimensions.groupBy(*keys)
        .agg(
            F.max("total_records").alias("total_records"),
            F.sort_array(F.collect_list(row)).alias("dimensions"),
            _worst_status().alias("gate_status"),
        )
        .withColumn("dimensions", F.transform("dimensions", lambda d: d.dropFields("position")))
        .withColumn(
            "generated_at", F.current_timestamp() if generated_at is None else generated_at
        )
    )


def promote(records: DataFrame, gates: DataFrame, keys: Sequence[str] = BATCH) -> DataFrame:
    """Records of the batches that did not fail; a warning still promotes."""
    passing = gates.filter(F.col("gate_status") != "fail").select(*keys)
    return records.join(passing, list(keys), "left_semi")


def display(dimensions: DataFrame, keys: Sequence[str] = BATCH) -> DataFrame:
    """Dimensions as shown in a report: score to four places, thresholds to three."""
    return dimensions.select(
        *keys,
        "dimension",
        F.format_string("%.4f", "score").alias("score"),
        F.format_string("%.3f", "warn_threshold").alias("warn_threshold"),
        F.format_string("%.3f", "fail_threshold").alias("fail_threshold"),
        F.upper("status").alias("status"),
        "detail",
    )


def run_summary(
    batches: DataFrame, gates: DataFrame, rejects: DataFrame, fetch_stats: DataFrame | None = None
) -> DataFrame:
    """Per batch: records, quarantined, gate and how many fetches stayed cheap or escalated."""
    keys = list(BATCH)
    quarantined = rejects.groupBy(*keys).agg(F.count("*").alias("quarantined_count"))
    out = (
        batches.select(*keys)
        .join(gates.withColumnRenamed("total_records", "record_count"), keys, "left")
        .join(quarantined, keys, "left")
    )
    counts = ["record_count", "quarantined_count"]
    if fetch_stats is not None:
        out = out.join(fetch_stats, keys, "left")
    else:
        out = out.withColumns(
            {"http_only_fetch_count": F.lit(0), "escalated_fetch_count": F.lit(0)}
        )
    counts += ["http_only_fetch_count", "escalated_fetch_count"]
    return out.select(
        *keys, "gate_status", *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in counts]
    )


def manifest(summary: DataFrame, runs: DataFrame, finished_at: Column) -> DataFrame:
    """Run manifests: per run a map of record counts by site and of error counts.

    A run's map has one entry per site of that run, so its size is that of the site registry.
    """
    by_run = summary.groupBy("run_id").agg(
        F.map_from_entries(
            F.sort_array(F.collect_list(F.struct("site_id", "record_count")))
        ).alias("site_counts"),
        F.sum("quarantined_count").alias("_quarantined"),
    )
    starts = runs.groupBy("run_id").agg(
        F.min("started_at").alias("started_at"), F.min("scraper_version").alias("git_sha")
    )
    return by_run.join(starts, "run_id").select(
        "run_id",
        "started_at",
        finished_at.alias("finished_at"),
        "site_counts",
        F.create_map(F.lit("quarantined"), F.col("_quarantined")).alias("error_counts"),
        "git_sha",
    )


def quarantine_rollup(rejects: DataFrame) -> DataFrame:
    """Rejected rows by site, day and reason, with subtotals (null = all)."""
    day = F.to_date("quarantined_at").alias("dt")
    return rejects.select("site_id", day, "reason").rollup("site_id", "dt", "reason").agg(
        F.count("*").alias("rejected")
    )


def staged_ratio(staged: DataFrame, rejects: DataFrame) -> DataFrame:
    """Share of staged among staged and quarantined rows, per site."""
    both = staged.select("site_id", F.lit(1).alias("kept")).unionByName(
        rejects.select("site_id", F.lit(0).alias("kept"))
    )
    return both.groupBy("site_id").agg(
        F.sum("kept").alias("staged"),
        F.sum(1 - F.col("kept")).alias("quarantined"),
        F.avg("kept").alias("staged_ratio"),
    )
