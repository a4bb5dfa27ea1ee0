"""Quality scores and gate."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gristmill.operators import quality

SCHEMA = (
    "site_id string, run_id string, title string, price double, currency string, "
    "content_hash string, completeness_score double"
)


def rec(n=0, title="t", price=10.0, currency="GBP", content=None, completeness=1.0):
    return ("s", "r", title, price, currency, content or f"h{n}", completeness)


def evaluate(spark, rows, profile="strict"):
    records = spark.createDataFrame(rows, SCHEMA)
    batches = spark.createDataFrame([("s", "r", profile)], "site_id string, run_id string, dq_profile string")
    (row,) = quality.evaluate(records, batches, quality.default_profiles(spark)).collect()
    return row, {d.dimension: d for d in row.dimensions}


def test_clean_batch_passes(spark):
    row, dims = evaluate(spark, [rec(i) for i in range(5)])
    assert row.gate_status == "pass" and row.total_records == 5
    assert list(dims) == list(quality.DIMENSIONS)
    assert all(d.score == 1.0 and d.status == "pass" for d in dims.values())
    assert dims["uniqueness"].detail == "5 unique of 5 content hashes"


def test_empty_batch_fails_everywhere(spark):
    row, dims = evaluate(spark, [])
    assert row.gate_status == "fail" and row.total_records == 0
    assert all(d.score == 0.0 and d.status == "fail" for d in dims.values())
    assert dims["validity"].detail == "no records to validate"


@pytest.mark.parametrize(
    "rows, dimension, score",
    [
        ([rec(1, content="h"), rec(2, content="h")], "uniqueness", 0.5),
        ([rec(1), rec(2, price=-5.0)], "validity", 0.5),
        ([rec(1), rec(2, price=0.0, title="", currency="EURO")], "validity", 0.5),
        ([rec(1), rec(2, title=None)], "validity", 0.5),
        ([rec(1), rec(2, price=float("nan"))], "validity", 0.5),
        ([rec(1), rec(2, currency=None)], "consistency", 0.5),
        ([rec(1), rec(2, completeness=0.5)], "completeness", 0.75),
    ],
)
def test_one_bad_dimension_fails_the_gate(spark, rows, dimension, score):
    row, dims = evaluate(spark, rows)
    assert dims[dimension].score == score and dims[dimension].status == "fail"
    assert row.gate_status == "fail"


def test_no_prices_at_all_is_valid(spark):
    row, dims = evaluate(spark, [rec(i, price=None, currency=None) for i in range(3)])
    assert row.gate_status == "pass" and dims["validity"].score == 1.0


def test_warn_between_thresholds_still_promotes(spark):
    rows = [rec(i) for i in range(97)] + [rec(i, price=-1.0) for i in range(97, 100)]
    row, dims = evaluate(spark, rows)
    assert dims["validity"].score == pytest.approx(0.97) and row.gate_status == "warn"
    gates = spark.createDataFrame([("s", "r", "warn")], "site_id string, run_id string, gate_status string")
    assert quality.promote(spark.createDataFrame(rows, SCHEMA), gates).count() == 100


def test_unknown_profile_is_an_error(spark):
    with pytest.raises(PySparkException, match="unknown dq_profile"):
        evaluate(spark, [rec()], profile="lax")


def test_failure_cases_list_every_check(spark):
    records = spark.createDataFrame([rec(1, title="", price=-1.0), rec(2)], SCHEMA)
    checks = [r.failed_check for r in quality.failure_cases(records).collect()]
    assert checks == ["title", "price"]


def test_manifest_maps(spark):
    batches = spark.createDataFrame([("a", "r"), ("b", "r")], "site_id string, run_id string")
    gates = spark.createDataFrame(
        [("a", "r", 3, "pass")], "site_id string, run_id string, total_records long, gate_status string"
    )
    rejects = spark.createDataFrame([("b", "r")], "site_id string, run_id string")
    summary = quality.run_summary(batches, gates, rejects)
    runs = spark.sql("select 'r' run_id, timestamp'2026-01-01' started_at, 'sha' scraper_version")
    row = quality.manifest(summary, runs, F.lit("2026-01-02").cast("timestamp")).first()
    assert row.site_counts == {"a": 3, "b": 0} and row.error_counts == {"quarantined": 1}


def test_uniqueness_counts_a_hot_batch_in_parallel(spark):
    """The distinct count is pre-aggregated by hash, not collected per batch."""
    records = spark.range(1000).select(
        F.lit("s").alias("site_id"), F.lit("r").alias("run_id"), F.lit("t").alias("title"),
        F.lit(1.0).alias("price"), F.lit("GBP").alias("currency"),
        (F.col("id") % 900).cast("string").alias("content_hash"), F.lit(1.0).alias("completeness_score"),
    )
    counts = quality.batch_counts(records)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    first_shuffle = plan.split("hashpartitioning(")[-1].split(")")[0]
    assert "content_hash" in first_shuffle, plan
    assert counts.first().unique_hashes == 900
