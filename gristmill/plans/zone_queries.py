"""Registry, zone and whole-run queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators import attributes, extract
from gristmill.plans.adapters import (
    all_pages,
    all_runs,
    all_sites,
    listing_pages,
    naive,
    shop_registry,
    shop_runs,
    table,
)
from gristmill.plans.catalog import query
from gristmill.plans.extract_queries import ITEMS, LEADS
from gristmill.session import shared_dir
from gristmill.sources import registry, zones


def fresh_root(spark: SparkSession, name: str) -> str:
    """A fresh root in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/zones-{name}-{uuid.uuid4().hex}"


@query(
    """SELECT DISTINCT l_suppkey + CASE WHEN l_linenumber = 7 THEN 1000000 ELSE 0 END AS wanted,
           CASE WHEN s_suppkey IS NULL THEN 'site ''' || (l_suppkey + 1000000) || ''' is not registered'
                WHEN s_acctbal <= 0 THEN 'site ''' || l_suppkey || ''' is registered but disabled' END
             AS error
    FROM lineitem LEFT JOIN supplier
      ON s_suppkey = l_suppkey + CASE WHEN l_linenumber = 7 THEN 1000000 ELSE 0 END"""
)
def site_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as registered sites; line items ask for them, some for unknown ones."""
    lines = table(spark, sf_dir, "lineitem")
    wanted = F.col("l_suppkey") + F.when(F.col("l_linenumber") == 7, 1000000).otherwise(0)
    requested = lines.select(wanted.cast("string").alias("site_id")).distinct()
    sites = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), (F.col("s_acctbal") > 0).alias("enabled")
    )
    resolved = registry.resolve_sites(requested, sites)
    return resolved.select(F.col("site_id").cast("long").alias("wanted"), "error")


@query(
    """SELECT s_suppkey, concat_ws('; ',
             CASE WHEN s_suppkey % 5 = 0 THEN 'missing module' END,
             CASE WHEN s_suppkey % 7 = 0 THEN 'missing rate_limit' END,
             CASE WHEN s_suppkey % 7 <> 0 AND s_suppkey % 6 = 0 THEN 'missing rate_limit.rps' END,
             CASE WHEN s_suppkey % 3 = 0 THEN 'unknown strategy: quantum' END) AS errors
    FROM supplier"""
)
def registry_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    limits = F.struct(
        F.when(key % 6 != 0, F.lit(2.0)).alias("rps"),
        F.lit(5).alias("burst"),
        F.lit(True).alias("respect_crawl_delay"),
    )
    rows = supplier.select(
        "s_suppkey",
        F.col("s_name").alias("id"),
        F.when(key % 5 != 0, "quote").alias("module"),
        F.lit(True).alias("enabled"),
        F.lit("0 2 * * *").alias("schedule"),
        F.when(key % 3 == 0, "quantum").otherwise("http").alias("strategy"),
        F.when(key % 7 != 0, limits).alias("rate_limit"),
        F.lit("strict").alias("dq_profile"),
    )
    checked = registry.validate_registry(rows)
    return checked.select("s_suppkey", F.array_join("errors", "; ").alias("errors"))


@query(
    f"""WITH {ITEMS}
    SELECT sha256(site_id || ':' || source_url) AS record_id, site_id, source_url, 'r1' AS run_id,
           'v1' AS scraper_version, 'http' AS fetch_strategy, 'local' AS backend, title,
           round(digits::DOUBLE, 6) AS price, 'GBP' AS currency, availability,
           '{{"rating":' || rating || ',"image_url":"' || image_url || '"}}' AS attributes_json,
           TIMESTAMP '2026-01-01' + INTERVAL 1 SECOND * page_ord AS scraped_at,
           'css' AS extraction_method
    FROM items WHERE reason IS NULL"""
)
def records_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = extract.extract(listing_pages(spark, sf_dir))
    out = zones.records_out(extract.records_of(extracted, shop_runs(spark, sf_dir)))
    out = out.withColumn("price", F.round("price", 6))
    return naive(out.drop("content_hash", "completeness_score"))


@query(
    """SELECT regexp_extract(url, '^https?://([^/?#]*)', 1) AS site, '2026-01-01' AS dt, 'r1' AS run,
           substr(sha256(url), 1, 16) AS url_hash, sha256(html) AS body_hash,
           (CASE WHEN page_id % 4 = 0 THEN 503 ELSE 200 END)::BIGINT AS status_code
    FROM pages"""
)
def raw_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`pages` written to the raw zone, whatever their status, and read back."""
    root = fresh_root(spark, "raw")
    zones.write_raw(_fetched(spark, sf_dir), root)
    stored = zones.read_raw(spark, root).filter(F.col("run") == "r1")
    return stored.select(
        F.col("site").cast("string").alias("site"),
        F.col("dt").cast("string").alias("dt"),
        "run",
        "url_hash",
        F.sha2("body", 256).alias("body_hash"),
        F.col("status_code").cast("long").alias("status_code"),
    )


@query(
    """SELECT CASE WHEN page_id % 3 = 0 THEN '007' ELSE regexp_extract(url, '^https?://([^/?#]*)', 1) END
             AS site, '2026-01-01' AS dt, 'r' || page_id % 2 AS run, substr(sha256(url), 1, 16) AS url_hash,
           sha256(html) AS body_hash
    FROM pages WHERE page_id % 2 = 1
    QUALIFY row_number() OVER (PARTITION BY site, url_hash ORDER BY page_id DESC) = 1"""
)
def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`pages` stored as single gzip objects, and those of one run read back; a site is called 007."""
    root = fresh_root(spark, "files")
    named = F.when(F.col("page_ord") % 3 == 0, "007").otherwise(F.col("site_id"))
    run = F.concat(F.lit("r"), F.col("page_ord") % 2)
    zones.write_raw_files(
        _fetched(spark, sf_dir).withColumns({"site_id": named, "run_id": run}), root
    ).agg(F.sum("length")).first()
    stored = zones.read_raw_files(spark, root).where("run = 'r1'")
    return stored.select(
        "site", F.col("dt").cast("string").alias("dt"), "run", "url_hash", F.sha2("body", 256).alias("body_hash")
    )


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        F.regexp_extract("url", "^https?://([^/?#]*)", 1).alias("site_id"),
        F.lit("r1").alias("run_id"),
        F.col("page_id").alias("page_ord"),
        "url",
        F.when(F.col("page_id") % 4 == 0, 503).otherwise(200).alias("status_code"),
        F.create_map(F.lit("server"), F.lit("x")).alias("headers"),
        F.encode("html", "UTF-8").alias("body"),
        F.expr("timestamp'2026-01-01 00:00:00'").alias("fetched_at"),
        F.lit("text/html").alias("content_type"),
    )


@query(
    """SELECT 'raw/site=' || regexp_extract(url, '^https?://([^/?#]*)', 1) || '/dt=2026-01-01/run=r1'
             AS folder FROM pages GROUP BY 1"""
)
def zone_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders under a prefix of the zones, from the file listing alone."""
    root = fresh_root(spark, "inventory")
    zones.write_raw(_fetched(spark, sf_dir), root)
    listed = zones.inventory(spark, root, "raw/site=")
    folder = F.regexp_replace("key", "/[^/]*$", "")
    return listed.filter(F.col("length") > 0).select(folder.alias("folder")).distinct()


RUN = f"""{ITEMS},
kept AS (
  SELECT *, CASE WHEN availability IS NULL THEN 0.75 ELSE 1.0 END AS completeness FROM items
  WHERE reason IS NULL QUALIFY row_number() OVER (
    PARTITION BY title || '|' || digits || '|' || coalesce(availability, 'None')
    ORDER BY page_ord, k) = 1),
sites AS (SELECT DISTINCT 'shop_' || (p_partkey // 20) % 5 AS site_id FROM part),
scored AS (
  SELECT s.site_id, count(k.site_id) AS record_count, coalesce(avg(completeness), 0.0) AS c
  FROM sites s LEFT JOIN kept k USING (site_id) GROUP BY s.site_id),
gated AS (
  SELECT *, CASE WHEN record_count = 0 OR c < 0.95 THEN 'fail' WHEN c < 0.99 THEN 'warn'
                 ELSE 'pass' END AS gate_status FROM scored)"""


@query(
    f"""WITH {RUN}
    SELECT site_id, 'r1' AS run_id, gate_status, record_count,
           (SELECT count(*) FROM items i WHERE i.site_id = gated.site_id AND reason IS NOT NULL)
             AS quarantined_count, 0::BIGINT AS http_only_fetch_count, 0::BIGINT AS escalated_fetch_count
    FROM gated"""
)
def site_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run over listing pages: extract, dedupe, score, gate and store."""
    from gristmill.plans.site_run import run_batch

    tables = run_batch(
        spark,
        listing_pages(spark, sf_dir).drop("module"),
        shop_runs(spark, sf_dir),
        shop_registry(spark, sf_dir),
        fresh_root(spark, "run"),
    )
    return tables.summary


@query(
    f"""WITH {RUN}
    SELECT site_id AS domain, source_url, title, round(digits::DOUBLE, 6) AS price
    FROM kept JOIN gated USING (site_id) WHERE gate_status <> 'fail'"""
)
def site_run_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the whole run promoted, read from the curated zone after the run was repeated."""
    from gristmill.plans.site_run import run_batch

    root = fresh_root(spark, "curated")
    inputs = (
        listing_pages(spark, sf_dir).drop("module"),
        shop_runs(spark, sf_dir),
        shop_registry(spark, sf_dir),
    )
    for _ in range(2):
        run_batch(spark, *inputs, root)
    schema = "source_url string, title string, price double, domain string, dt date, run string"
    curated = zones.read_zone(spark, root, "curated", schema)
    return curated.select("domain", "source_url", "title", F.round("price", 6).alias("price"))


@query(
    """WITH pages AS (
      SELECT 'shop_' || (p_partkey // 20) % 5 AS site_id, count(DISTINCT p_partkey // 20) AS n
      FROM part GROUP BY 1)
    SELECT site_id, 'r1' AS run_id, n AS pages,
           CASE site_id WHEN 'shop_0' THEN 'site ''shop_0'' is not registered'
             WHEN 'shop_1' THEN 'site ''shop_1'' is registered but disabled'
             WHEN 'shop_2' THEN 'site ''shop_2'' has no extractor for forum'
             ELSE 'site ''shop_3'' has pages without a run' END AS error
    FROM pages WHERE site_id <> 'shop_4'
    UNION ALL SELECT 'shop_9', 'r1', 0, 'site ''shop_9'' is not registered'"""
)
def site_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run could not process: sites that are unknown, disabled or unroutable, pages without a run."""
    from gristmill.plans.site_run import run_batch

    root = fresh_root(spark, "errors")
    sites = shop_registry(spark, sf_dir).where("id <> 'shop_0'").withColumns({
        "enabled": F.col("id") != "shop_1",
        "module": F.when(F.col("id") == "shop_2", "forum").otherwise(F.col("module")),
    })
    runs = shop_runs(spark, sf_dir).where("site_id <> 'shop_3'")
    runs = runs.unionByName(runs.where("site_id = 'shop_4'").withColumn("site_id", F.lit("shop_9")))
    run_batch(spark, listing_pages(spark, sf_dir).drop("module"), runs, sites, root)
    return zones.read_site_errors(spark, root)


def _twice(spark: SparkSession, sf_dir: str, root: str, times: int = 1) -> None:
    """A run over a third of the pages, then one a day later over all of them, `times` times."""
    from gristmill.plans.site_run import run_batch

    pages = listing_pages(spark, sf_dir).drop("module")
    runs, sites = shop_runs(spark, sf_dir), shop_registry(spark, sf_dir)
    run_batch(spark, pages.where("page_ord % 3 = 0"), runs, sites, root)
    later = runs.withColumns({"run_id": F.lit("r2"), "started_at": F.expr("started_at + interval 1 day")})
    for _ in range(times):
        run_batch(spark, pages.withColumn("run_id", F.lit("r2")), later, sites, root)


TWICE = f"""{ITEMS},
hashed AS (
  SELECT *, title || '|' || digits || '|' || coalesce(availability, 'None') AS hash FROM items
  WHERE reason IS NULL),
early AS (
  SELECT * FROM hashed WHERE page_ord % 3 = 0
  QUALIFY row_number() OVER (PARTITION BY hash ORDER BY page_ord, k) = 1),
late AS (
  SELECT * FROM hashed WHERE hash NOT IN (SELECT hash FROM early)
  QUALIFY row_number() OVER (PARTITION BY hash ORDER BY page_ord, k) = 1),
stored AS (
  SELECT 'r1' AS run, DATE '2026-01-01' AS dt, * FROM early
  UNION ALL SELECT 'r2', DATE '2026-01-02', * FROM late)"""


@query(f"WITH {TWICE} SELECT run, site_id AS site, source_url, title FROM stored")
def run_twice_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs staged, the second one without what the first one has seen."""
    root = fresh_root(spark, "twice")
    _twice(spark, sf_dir, root)
    return zones.read_zone(spark, root, "staging").select("run", "site", "source_url", "title")


@query(
    f"""WITH {TWICE}
    SELECT run, site_id AS site, dt, sha256(site_id || ':' || source_url) AS record_id, source_url,
           round(digits::DOUBLE, 6) AS price, sha256(hash) AS content_hash,
           CASE WHEN availability IS NULL THEN 0.75 ELSE 1.0 END::DOUBLE AS completeness_score
    FROM stored"""
)
def staging_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging zone after two runs of which the second was repeated."""
    root = fresh_root(spark, "staging")
    _twice(spark, sf_dir, root, times=2)
    staged = zones.read_zone(spark, root, "staging")
    return staged.select(
        "run", "site", "dt", "record_id", "source_url", F.round("price", 6).alias("price"), "content_hash",
        "completeness_score",
    )


@query(
    f"""WITH {ITEMS}
    SELECT 'r1' AS run, DATE '2026-01-01' AS dt, site_id AS site, url AS source_url, reason
    FROM items WHERE reason IS NOT NULL AND page_ord % 3 = 0
    UNION ALL
    SELECT 'r2', DATE '2026-01-02', site_id, url, reason FROM items
    WHERE reason IS NOT NULL AND page_ord % 2 = 0"""
)
def quarantine_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects of two runs; a repeat of the second over half of its pages left only theirs."""
    from gristmill.plans.site_run import run_batch

    root = fresh_root(spark, "quarantine")
    _twice(spark, sf_dir, root)
    pages = listing_pages(spark, sf_dir).drop("module").where("page_ord % 2 = 0")
    runs = shop_runs(spark, sf_dir)
    later = runs.withColumns({"run_id": F.lit("r2"), "started_at": F.expr("started_at + interval 1 day")})
    run_batch(spark, pages.withColumn("run_id", F.lit("r2")), later, shop_registry(spark, sf_dir), root)
    rejected = zones.read_zone(spark, root, "quarantine")
    return rejected.select("run", "dt", "site", "source_url", "reason")


STRICTER = "0.981"


@query(
    f"""WITH {RUN.replace("c < 0.95", f"c < {STRICTER}")}
    SELECT site_id AS domain, source_url, title FROM kept JOIN gated USING (site_id)
    WHERE gate_status <> 'fail'"""
)
def regate_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated zone after a run was repeated under a stricter profile: sites that passed at
    first and fail now are no longer in it."""
    from gristmill.operators import quality
    from gristmill.plans.site_run import run_batch

    root = fresh_root(spark, "regate")
    inputs = (
        listing_pages(spark, sf_dir).drop("module"), shop_runs(spark, sf_dir), shop_registry(spark, sf_dir),
    )
    run_batch(spark, *inputs, root)
    limit = F.when(F.col("dimension") == "completeness", float(STRICTER)).otherwise(F.col("fail_threshold"))
    stricter = quality.default_profiles(spark).withColumn("fail_threshold", limit)
    run_batch(spark, *inputs, root, profiles=stricter)
    schema = "source_url string, title string, domain string, dt date, run string"
    return zones.read_zone(spark, root, "curated", schema).select("domain", "source_url", "title")


@query(
    f"""WITH {TWICE}, counted AS (
      SELECT site_id, count(*) AS n, coalesce(avg(CASE WHEN availability IS NULL THEN 0.75 ELSE 1.0 END), 0) AS c
      FROM late GROUP BY site_id),
    sites AS (SELECT DISTINCT 'shop_' || (p_partkey // 20) % 5 AS site_id FROM part)
    SELECT site_id, 'r2' AS run_id, coalesce(n, 0) AS staged,
           CASE WHEN coalesce(c, 0) < 0.95 THEN 0 ELSE n END AS curated
    FROM sites LEFT JOIN counted USING (site_id)"""
)
def latest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest report of each site after two runs, with the row counts that its job committed."""
    root = fresh_root(spark, "reports")
    _twice(spark, sf_dir, root)
    latest = zones.latest_reports(zones.read_zone(spark, root, "reports"))
    counts = zones.committed(spark, root).select("site_id", "run_id", "staged", "curated")
    return latest.select("site_id", "run_id").join(counts, ["site_id", "run_id"])


ATTRIBUTES = f"""{ITEMS}, {LEADS},
found AS (
  SELECT site_id AS site, sha256(site_id || ':' || source_url) AS record_id, rating, image_url,
         NULL AS author, NULL AS tags, NULL AS short_description, NULL AS summary
  FROM items WHERE reason IS NULL
  UNION ALL
  SELECT 'quotes', sha256('quotes:https://quotes.example/' || doc_id || ':' || trim(text, chr(10) || ' ')),
         NULL, NULL, source, [lang, 'all'], NULL, NULL
  FROM documents WHERE doc_id % 15 <> 0 AND doc_id % 10 <> 0
  UNION ALL
  SELECT 'articles', sha256('articles:https://wiki.example/' || doc_id), NULL, NULL, NULL, NULL,
         CASE WHEN doc_id % 7 <> 0 THEN source END, lead
  FROM leads WHERE lead IS NOT NULL)"""


def _stored_attributes(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Attributes of listings, quotes and articles, written to their zone and read back."""
    root = fresh_root(spark, name)
    runs = all_runs(spark, sf_dir)
    extracted = extract.extract_sites(all_pages(spark, sf_dir).drop("module"), all_sites(spark, sf_dir))
    zones.write_attributes(extract.records_of(extracted, runs), runs, root)
    zones.commit(runs, root, 0)
    return zones.read_zone(spark, root, "attributes").select("site", "record_id", "attributes")


@query(
    f"""WITH {ATTRIBUTES}
    SELECT site, record_id, '$.rating' AS path, 'BIGINT' AS type, rating::VARCHAR AS value
    FROM found WHERE site LIKE 'shop%'
    UNION ALL SELECT site, record_id, '$.image_url', 'STRING', image_url FROM found WHERE site LIKE 'shop%'
    UNION ALL SELECT site, record_id, '$.author', 'STRING', author FROM found WHERE site = 'quotes'
    UNION ALL SELECT site, record_id, '$.tags', 'ARRAY<STRING>', '["' || tags[1] || '","' || tags[2] || '"]'
    FROM found WHERE site = 'quotes'
    UNION ALL SELECT site, record_id, '$.short_description',
                     CASE WHEN short_description IS NULL THEN 'VOID' ELSE 'STRING' END, short_description
    FROM found WHERE site = 'articles'
    UNION ALL SELECT site, record_id, '$.summary', 'STRING', summary FROM found WHERE site = 'articles'"""
)
def attributes_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every attribute of every record of all page kinds, by path."""
    return attributes.by_path(_stored_attributes(spark, sf_dir, "paths"))


@query(
    f"""WITH {ATTRIBUTES}
    SELECT site, count(*) AS records, sum(rating)::BIGINT AS ratings, count(author) AS authors,
           coalesce(sum(len(tags)), 0)::BIGINT AS tags, coalesce(sum(length(summary)), 0)::BIGINT AS summary_chars
    FROM found GROUP BY site"""
)
def attributes_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per site over typed paths, of which the scan reads only these."""
    paths = {
        "rating": ("$.rating", "bigint"), "author": ("$.author", "string"), "tags": ("$.tags", "array<string>"),
        "summary": ("$.summary", "string"),
    }
    rows = attributes.typed(_stored_attributes(spark, sf_dir, "typed"), paths)
    zero = F.lit(0).cast("long")
    return rows.groupBy("site").agg(
        F.count("*").alias("records"),
        F.sum("rating").alias("ratings"),
        F.count("author").alias("authors"),
        F.coalesce(F.sum(F.when(F.col("tags").isNotNull(), F.size("tags"))), zero).alias("tags"),
        F.coalesce(F.sum(F.length("summary")), zero).alias("summary_chars"),
    )
