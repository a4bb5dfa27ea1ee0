"""Site registry: lookup and row validation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import fixed_values as V
from gristmill import schemas
from gristmill.session import small_table


def default_registry(spark: SparkSession) -> DataFrame:
    """The four registered sites."""
    rows = [
        (site, module, True, schedule, strategy, (rps, burst, True), "strict")
        for site, module, schedule, strategy, rps, burst in V.REGISTERED_SITES
    ]
    return small_table(spark, rows, schemas.SITE_REGISTRY)


def resolve_sites(requested: DataFrame, registry: DataFrame) -> DataFrame:
    """`requested(site_id)` with registry columns and `error`, null for a site that can run."""
    registered = registry.withColumnRenamed("id", "site_id")
    quoted = F.concat(F.lit("site '"), F.col("site_id"), F.lit("' "))
    error = F.when(
        F.col("enabled").isNull(), F.concat(quoted, F.lit("is not registered"))
    ).when(~F.col("enabled"), F.concat(quoted, F.lit("is registered but disabled")))
    return requested.join(registered, "site_id", "left").withColumn("error", error)


def site_errors(pages: DataFrame, runs: DataFrame, registry: DataFrame, kinds: Iterable[str]) -> DataFrame:
    """(site_id, run_id, pages, error) of every site and run that a job over `pages` and `runs` cannot process.

    The site is not registered, is disabled, or its row names a page kind that is not among `kinds`; or there
    are pages without a run, whose records would have no lineage. No row means that nothing is left
    out. `pages` counts the pages concerned.
    """
    key = ["site_id", "run_id"]
    counts = pages.groupBy(*key).agg(F.count("*").alias("pages"))
    asked = runs.select(*key).distinct().withColumn("run", F.lit(True))
    # a union and not an outer join, which would tell null ids apart
    asked = asked.unionByName(counts, allowMissingColumns=True).groupBy(*key)
    asked = asked.agg(F.max("run").alias("run"), F.max("pages").alias("pages"))
    resolved = resolve_sites(asked, registry.select("id", "enabled", "module"))
    quoted = F.concat(F.lit("site '"), F.col("site_id"), F.lit("' "))
    error = F.coalesce(
        F.when(F.col("site_id").isNull(), "page without a site"),
        "error",
        F.when(
            ~F.coalesce(F.col("module").isin(*kinds), F.lit(False)),
            F.concat(quoted, F.lit("has no extractor for "), F.coalesce("module", F.lit("null"))),
        ),
        F.when(F.col("run").isNull(), F.concat(quoted, F.lit("has pages without a run"))),
    )
    rows = resolved.select(*key, F.coalesce("pages", F.lit(0)).alias("pages"), error.alias("error"))
    return rows.where(F.col("error").isNotNull())


_REQUIRED = (
    "id",
    "module",
    "enabled",
    "schedule",
    "strategy",
    "rate_limit",
    "rate_limit.rps",
    "rate_limit.burst",
    "dq_profile",
)


def validate_registry(rows: DataFrame) -> DataFrame:
    """Registry rows with `errors`: missing fields, an unknown strategy, or limits that are no
    numbers (a value of the wrong type arrives as null from a typed reader)."""
    checks = [
        F.when(F.col(name).isNull(), F.lit(f"missing {name}"))
        for name in _REQUIRED
        if not name.startswith("rate_limit.")
    ]
    checks += [
        F.when(F.col("rate_limit").isNotNull() & F.col(name).isNull(), F.lit(f"missing {name}"))
        for name in _REQUIRED
        if name.startswith("rate_limit.")
    ]
    checks += [
        F.when(
            ~F.col("strategy").isin("http", "browser"),
            F.concat(F.lit("unknown strategy: "), F.col("strategy")),
        ),
        F.when(F.isnan("rate_limit.rps"), F.lit("rate_limit.rps is not a number")),
    ]
    return rows.withColumn("errors", F.array_compact(F.array(*checks)))
