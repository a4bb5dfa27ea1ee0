"""Quality queries over `part` seen as records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators import quality, sketches
from gristmill.plans.adapters import records, table
from gristmill.plans.catalog import query
from gristmill.plans.zone_queries import fresh_root
from gristmill.sources import zones

REC = """
rec AS (
  SELECT p_partkey, p_size, site_id, run_id, title, price, currency, content_hash,
         ((title <> '')::INT + (price IS NOT NULL)::INT + (currency IS NOT NULL)::INT) / 3.0
           AS completeness_score
  FROM (
    SELECT p_partkey, p_size, p_brand AS site_id, 'r1' AS run_id,
           CASE WHEN p_brand <> 'Brand#9' AND p_partkey % 101 = 0 THEN '' ELSE p_name END AS title,
           CASE WHEN p_brand <> 'Brand#9' AND p_partkey % 89 = 0 THEN NULL
                WHEN p_brand <> 'Brand#9' AND p_partkey % 83 = 0 THEN -p_retailprice
                ELSE p_retailprice END AS price,
           CASE WHEN p_brand <> 'Brand#9' AND p_partkey % 97 = 0 THEN NULL ELSE 'USD' END AS currency,
           sha256(p_name || '|' || CAST(p_size AS VARCHAR)) AS content_hash
    FROM part))"""

DIMS = """
counted AS (
  SELECT b.site_id, count(r.site_id) AS n, avg(completeness_score) AS c,
         count(DISTINCT content_hash) AS u,
         coalesce(sum((title IS NULL OR length(title) < 1 OR coalesce(price <= 0, FALSE)
             OR coalesce(length(currency) <> 3, FALSE))::INT), 0)::BIGINT AS bad,
         coalesce(sum(((price IS NULL) = (currency IS NULL))::INT), 0) AS ok
  FROM batches b LEFT JOIN rec r ON r.site_id = b.site_id GROUP BY b.site_id),
long AS (
  SELECT site_id, n, 'completeness' AS dimension, CASE WHEN n = 0 THEN 0.0 ELSE c END AS score,
         0.99 AS warn, 0.95 AS fail,
         'mean per-record completeness across ' || n || ' records' AS detail FROM counted
  UNION ALL
  SELECT site_id, n, 'uniqueness', CASE WHEN n = 0 THEN 0.0 ELSE u::DOUBLE / n END, 0.995, 0.98,
         u || ' unique of ' || n || ' content hashes' FROM counted
  UNION ALL
  SELECT site_id, n, 'validity', CASE WHEN n = 0 THEN 0.0 ELSE 1 - bad::DOUBLE / n END, 0.99, 0.95,
         CASE WHEN n = 0 THEN 'no records to validate'
              ELSE bad || ' of ' || n || ' records failed a validity check' END FROM counted
  UNION ALL
  SELECT site_id, n, 'consistency', CASE WHEN n = 0 THEN 0.0 ELSE ok::DOUBLE / n END, 0.99, 0.95,
         'price and currency must both be present or both be absent' FROM counted),
dims AS (
  SELECT *, CASE WHEN score < fail THEN 'fail' WHEN score < warn THEN 'warn' ELSE 'pass' END AS status
  FROM long),
gates AS (
  SELECT site_id, max(n) AS n,
         CASE max(CASE status WHEN 'fail' THEN 2 WHEN 'warn' THEN 1 ELSE 0 END)
           WHEN 2 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'pass' END AS gate_status
  FROM dims GROUP BY site_id)"""

BRANDS = "batches AS (SELECT DISTINCT p_brand AS site_id FROM part)"


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = table(spark, sf_dir, "part").select(F.col("p_brand").alias("site_id")).distinct()
    return sites.select("site_id", F.lit("r1").alias("run_id"), F.lit("strict").alias("dq_profile"))


def _dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = quality.default_profiles(spark)
    return quality.score_dimensions(records(spark, sf_dir), _batches(spark, sf_dir), profiles)


@query(
    f"""WITH {BRANDS}, {REC}, {DIMS}
    SELECT d.site_id, d.n AS total_records, dimension, round(score, 6) AS score,
           warn::DOUBLE AS warn_threshold, fail::DOUBLE AS fail_threshold, status, detail, gate_status
    FROM dims d JOIN gates g USING (site_id)"""
)
def dq_evaluate_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = quality.default_profiles(spark)
    reports = quality.evaluate(records(spark, sf_dir), _batches(spark, sf_dir), profiles)
    return reports.select("site_id", "total_records", F.inline("dimensions"), "gate_status").select(
        "site_id",
        "total_records",
        "dimension",
        F.round("score", 6).alias("score"),
        "warn_threshold",
        "fail_threshold",
        "status",
        "detail",
        "gate_status",
    )


@query(
    f"""WITH batches AS (SELECT DISTINCT p_brand AS site_id FROM part
                         UNION ALL SELECT s_name FROM supplier), {REC}, {DIMS}
    SELECT site_id, n AS total_records, dimension, round(score, 6) AS score, status, detail FROM dims"""
)
def dq_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers are expected sites without a single record."""
    silent = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("site_id"),
        F.lit("r1").alias("run_id"),
        F.lit("strict").alias("dq_profile"),
    )
    batches = _batches(spark, sf_dir).unionByName(silent)
    dims = quality.score_dimensions(
        records(spark, sf_dir), batches, quality.default_profiles(spark)
    )
    return dims.select(
        "site_id",
        "total_records",
        "dimension",
        F.round("score", 6).alias("score"),
        "status",
        "detail",
    )


@query(
    f"""WITH {REC}
    SELECT p_partkey, site_id, 'title' AS failed_check FROM rec WHERE title IS NULL OR length(title) < 1
    UNION ALL SELECT p_partkey, site_id, 'price' FROM rec WHERE price <= 0
    UNION ALL SELECT p_partkey, site_id, 'currency' FROM rec WHERE length(currency) <> 3"""
)
def dq_failure_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = quality.failure_cases(records(spark, sf_dir))
    return cases.select("p_partkey", "site_id", "failed_check")


@query(
    f"""WITH {BRANDS}, {REC}, {DIMS}
    SELECT r.p_partkey, r.site_id, r.title FROM rec r JOIN gates g USING (site_id)
    WHERE gate_status <> 'fail'"""
)
def dq_gate_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    gates = quality.gate(_dimensions(spark, sf_dir))
    promoted = quality.promote(records(spark, sf_dir), gates)
    return promoted.select("p_partkey", "site_id", "title")


@query(
    f"""WITH {BRANDS}, {REC}, {DIMS}
    SELECT site_id, 'r1' AS run_id, dimension, printf('%.4f', score::DOUBLE) AS score,
           printf('%.3f', warn::DOUBLE) AS warn_threshold, printf('%.3f', fail::DOUBLE) AS fail_threshold,
           upper(status) AS status, detail
    FROM dims"""
)
def dq_report_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.display(_dimensions(spark, sf_dir))


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = records(spark, sf_dir)
    rejected = kept.filter("price is null").select("site_id", "run_id")
    stats = kept.groupBy("site_id", "run_id").agg(
        F.count_if(F.col("p_size") >= 5).alias("http_only_fetch_count"),
        F.count_if(F.col("p_size") < 5).alias("escalated_fetch_count"),
    )
    gates = quality.gate(_dimensions(spark, sf_dir))
    return quality.run_summary(_batches(spark, sf_dir), gates, rejected, stats)


@query(
    f"""WITH {BRANDS}, {REC}, {DIMS}
    SELECT site_id, 'r1' AS run_id, gate_status, n AS record_count,
           (SELECT count(*) FROM rec r WHERE r.site_id = g.site_id AND price IS NULL)
             AS quarantined_count,
           (SELECT count(*) FROM rec r WHERE r.site_id = g.site_id AND p_size >= 5)
             AS http_only_fetch_count,
           (SELECT count(*) FROM rec r WHERE r.site_id = g.site_id AND p_size < 5)
             AS escalated_fetch_count
    FROM gates g"""
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir)


@query(
    f"""WITH {REC}
    SELECT 'r1' AS run_id, site_id, count(*) AS record_count,
           (SELECT count(*) FROM rec WHERE price IS NULL) AS quarantined
    FROM rec GROUP BY site_id"""
)
def manifest_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "part").select(
        F.lit("r1").alias("run_id"),
        F.expr("timestamp'2026-01-01'").alias("started_at"),
        F.lit("v1").alias("scraper_version"),
    )
    manifests = quality.manifest(
        _summary(spark, sf_dir), runs, F.expr("timestamp'2026-01-01 01:00:00'")
    )
    return manifests.select(
        "run_id",
        F.explode("site_counts").alias("site_id", "record_count"),
        F.col("error_counts")["quarantined"].alias("quarantined"),
    )


REJECTS = """
rejects AS (
  SELECT p_brand AS site_id, CAST(DATE '2026-01-01' + (p_partkey % 7)::INT AS DATE) AS dt,
         CASE p_partkey % 3 WHEN 0 THEN 'missing price' WHEN 1 THEN 'missing title' ELSE 'bad link' END
           AS reason
  FROM part)"""


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    reasons = F.array(*[F.lit(r) for r in ("missing price", "missing title", "bad link")])
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("p_partkey") % 7).cast("int"))
    return part.select(
        F.col("p_brand").alias("site_id"),
        day.cast("timestamp").alias("quarantined_at"),
        F.get(reasons, (F.col("p_partkey") % 3).cast("int")).alias("reason"),
    )


@query(
    f"""WITH {REJECTS}
    SELECT site_id, dt::VARCHAR AS dt, reason, count(*) AS rejected
    FROM rejects GROUP BY ROLLUP (site_id, dt, reason)"""
)
def quarantine_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = quality.quarantine_rollup(_rejects(spark, sf_dir))
    return rolled.withColumn("dt", F.col("dt").cast("string"))


@query(
    f"""WITH {REC}, {REJECTS}
    SELECT site_id, sum(kept)::BIGINT AS staged, sum(1 - kept)::BIGINT AS quarantined,
           round(avg(kept), 6) AS staged_ratio
    FROM (SELECT site_id, 1 AS kept FROM rec UNION ALL SELECT site_id, 0 FROM rejects)
    GROUP BY site_id"""
)
def staged_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = quality.staged_ratio(records(spark, sf_dir), _rejects(spark, sf_dir))
    return ratio.withColumn("staged_ratio", F.round("staged_ratio", 6))


@query(
    """SELECT source AS site_id, count(*) AS records, count(DISTINCT sha256(text)) AS distinct_hashes,
           TRUE AS within_bound
    FROM documents WHERE doc_id % 60 BETWEEN 21 AND 50 GROUP BY source"""
)
def uniqueness_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniqueness of thirty days of documents from stored daily sketches, held against exact counts."""
    day = F.date_add(F.lit("2026-01-01"), (F.col("doc_id") % 60).cast("int"))
    docs = table(spark, sf_dir, "documents").select(
        F.col("source").alias("site_id"), F.sha2("text", 256).alias("content_hash"), day.alias("day")
    )
    root, until = fresh_root(spark, "sketches"), F.to_date(F.lit("2026-02-20"))
    zones.save_sketches(sketches.daily_hashes(docs, F.col("day")), root, "hashes")
    merged = sketches.uniqueness_over(zones.read_sketches(spark, root, "hashes"), until)
    exact = docs.where(F.col("day").between(F.date_sub(until, 29), until)).groupBy("site_id")
    exact = exact.agg(F.count_distinct("content_hash").alias("exact"))
    off = F.abs(F.col("distinct_hashes") - F.col("exact"))
    return merged.join(exact, "site_id").select(
        "site_id", "records", F.col("exact").alias("distinct_hashes"),
        (off <= F.greatest(F.lit(1.0), 0.03 * F.col("exact"))).alias("within_bound"),
    )
