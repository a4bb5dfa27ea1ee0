"""The whole run: raw pages -> records -> dedupe -> gate -> zones, for many sites and runs at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import fixed_values as V
from gristmill.operators import dedupe, quality
from gristmill.operators.extract import EXTRACTORS, extract_sites, page_errors_of, records_of, rejects_of
from gristmill.session import cut
from gristmill.sources import seen, zones
from gristmill.sources.registry import site_errors


@dataclass(frozen=True)
class RunTables:
    """What a run produced; every table is stored and can be read again."""

    kept: DataFrame
    rejects: DataFrame
    page_errors: DataFrame
    dimensions: DataFrame
    report: DataFrame
    summary: DataFrame
    site_errors: DataFrame


class SiteError(RuntimeError):
    """Raised in fail-fast mode for a site that cannot be run."""


def run_batch(
    spark: SparkSession,
    pages: DataFrame,
    runs: DataFrame,
    registry: DataFrame,
    root: str,
    *,
    batch: int | None = None,
    profiles: DataFrame | None = None,
    fetch_stats: DataFrame | None = None,
    ttl_days: int = V.DEDUPE_TTL_DAYS,
    mark_before_gate: bool = True,
    fail_fast: bool = False,
) -> RunTables:
    """Process the fetched `pages` of `runs(run_id, site_id, started_at, scraper_version, backend)`.

    `pages` should be a stored table, since it is read twice: into the raw zone and by the parser.
    `batch` numbers this job; by default it is the next one, or that of an earlier job over the same
    runs, whose results a repeat replaces. Writes in this order: raw, staging, attributes, seen hashes, curated,
    quarantine, report, manifest, commit. Until the commit, readers of the zones see what was there
    before. Sites and pages that cannot be processed are rows of `site_errors`, which is stored with the
    reports; `fail_fast` raises on the first one, ahead of any write. With `mark_before_gate` the hashes of a failed batch are marked too and stay out until
    they expire.
    """
    profiles = quality.default_profiles(spark) if profiles is None else profiles
    errors = cut(site_errors(pages, runs, registry, EXTRACTORS), "site-errors")
    if fail_fast:
        for row in errors.orderBy("site_id", "run_id").head(1):
            raise SiteError(row.error)
    job = zones.claim(spark, runs, root, batch)
    zones.write_raw(pages, root)
    extracted = cut(extract_sites(pages, registry), "extracted")
    page_errors = page_errors_of(extracted, fail_fast=fail_fast)
    rejects = rejects_of(extracted)

    records = records_of(extracted, runs)
    own_runs = runs.select("run_id").distinct()
    first_start = runs.agg(F.min("started_at")).first()[0]
    marks = seen.known(records, root, before=job.batch).join(own_runs, "run_id", "left_anti")
    marks = marks.filter(F.col("expires_at") > F.lit(first_start))
    kept = dedupe.dedupe_history(
        records,
        ttl_days=ttl_days,
        order=("run_id", "page_ord", "element_ord"),
        seen=marks,
    )
    kept = cut(kept, "kept")

    batches = runs.select("site_id", "run_id").join(
        registry.select(F.col("id").alias("site_id"), "dq_profile"), "site_id"
    )
    dimensions = cut(quality.score_dimensions(kept, batches, profiles), "dimensions")
    gates = quality.gate(dimensions)
    promoted = quality.promote(kept, gates)

    zones.write_staging(kept, runs, root, job.attempt)
    zones.write_attributes(kept, runs, root, job.attempt)
    marked = dedupe.seen_rows(kept if mark_before_gate else promoted, ttl_days=ttl_days)
    seen.save(marked, root, job.batch, alive_at=F.lit(first_start))
    zones.write_curated(promoted, runs, root, job.attempt)
    zones.write_quarantine(rejects, runs, root, job.attempt)
    report = quality.report(dimensions)
    zones.write_report(report, root, job.attempt)
    zones.write_site_errors(errors, root, job.attempt)
    summary = quality.run_summary(batches, gates, rejects, fetch_stats)
    zones.save_manifests(quality.manifest(summary, runs, F.current_timestamp()), root, job.batch)
    zones.commit(runs, root, job.attempt, staged=kept, curated=promoted, quarantined=rejects)
    return RunTables(kept, rejects, page_errors, dimensions, report, summary, errors)

