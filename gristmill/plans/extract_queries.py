"""Extraction queries: `pages` as they are, and pages built from `part` and `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import authority, content_hash
from gristmill.operators import dedupe, extract, quality
from gristmill.operators.markup import Rule, Spec
from gristmill.plans.adapters import (
    article_pages,
    listing_pages,
    quote_pages,
    shop_runs,
    table,
)
from gristmill.plans.catalog import query

PAGE = Spec(
    "page",
    "",
    (
        Rule("title", "head > title", form="nfkc"),
        Rule("h1", "article > h1", form="nfkc"),
        Rule("paragraphs", "article p", "joined", many=True),
        Rule("links", "nav a", "@href", many=True, form="url"),
    ),
)

UNESCAPE = "replace(regexp_replace({}, '&amp;?', '&', 'g'), '&quot;', '\"')"


def harvested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract.harvest(pages, PAGE, keep=("page_id", "url"), body="html")


@query(
    f"""SELECT page_id, trim({UNESCAPE.format("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}) AS title,
           trim({UNESCAPE.format("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}) AS h1,
           len(regexp_extract_all(html, '<p>')) AS paragraphs
    FROM pages"""
)
def page_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = harvested_pages(spark, sf_dir)
    return found.select(
        "page_id",
        extract.first("title").alias("title"),
        extract.first("h1").alias("h1"),
        F.size(extract.every("paragraphs")).cast("long").alias("paragraphs"),
    )


@query(
    """SELECT page_id, link_ord::BIGINT AS link_ord,
           regexp_extract(url, '^(https?://[^/?#]*)', 1) || hrefs[link_ord + 1] AS link
    FROM (SELECT page_id, url, hrefs, unnest(range(len(hrefs))) AS link_ord FROM (
      SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages))"""
)
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = harvested_pages(spark, sf_dir)
    links = found.select("page_id", F.posexplode(extract.every("links")).alias("link_ord", "link"))
    return links.withColumn("link_ord", F.col("link_ord").cast("long"))


@query(
    f"""WITH found AS (
      SELECT page_id, regexp_extract(url, '^https?://([^/?#]*)', 1) AS site_id,
             trim({UNESCAPE.format("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}) AS title,
             trim({UNESCAPE.format("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}) AS h1
      FROM pages),
    kept AS (
      SELECT *, ((title <> '')::INT + (h1 <> '')::INT) / 2.0 AS completeness FROM found
      QUALIFY row_number() OVER (PARTITION BY sha256(title || '|' || h1) ORDER BY page_id) = 1),
    sites AS (SELECT DISTINCT site_id FROM found),
    scored AS (
      SELECT s.site_id, count(k.site_id) AS total_records, coalesce(avg(completeness), 0) AS c,
             coalesce(avg((title <> '')::INT), 0) AS v
      FROM sites s LEFT JOIN kept k ON k.site_id = s.site_id GROUP BY s.site_id)
    SELECT site_id, total_records, round(c, 6) AS completeness,
           CASE WHEN total_records = 0 OR c < 0.95 OR v < 0.95 THEN 'fail'
                WHEN c < 0.99 OR v < 0.99 THEN 'warn' ELSE 'pass' END AS gate_status
    FROM scored"""
)
def page_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Did each site's batch pass the quality gate? Real pages, extracted, deduped and scored."""
    found = harvested_pages(spark, sf_dir).select(
        "page_id",
        authority(F.col("url")).alias("site_id"),
        extract.first("title").alias("title"),
        extract.first("h1").alias("h1"),
    )
    records = found.select(
        "page_id",
        "site_id",
        F.lit("r1").alias("run_id"),
        "title",
        F.lit(None).cast("double").alias("price"),
        F.lit(None).cast("string").alias("currency"),
        content_hash(F.col("title"), F.col("h1")).alias("content_hash"),
        extract.present_share(F.col("title") != "", F.col("h1") != "").alias("completeness_score"),
    )
    kept = dedupe.dedupe_batch(records, order=("page_id",))
    expected = table(spark, sf_dir, "pages").select(authority(F.col("url")).alias("site_id"))
    batches = expected.distinct().select(
        "site_id", F.lit("r1").alias("run_id"), F.lit("strict").alias("dq_profile")
    )
    reports = quality.evaluate(kept, batches, quality.default_profiles(spark))
    completeness = F.filter("dimensions", lambda d: d["dimension"] == "completeness")
    return reports.select(
        "site_id",
        "total_records",
        F.round(F.get(completeness, F.lit(0))["score"], 6).alias("completeness"),
        "gate_status",
    )


ITEMS = """
items AS (
  SELECT p_partkey AS k, p_partkey // 20 AS page_ord, 'shop_' || (p_partkey // 20) % 5 AS site_id,
         'https://shop.example/catalogue/page-' || p_partkey // 20 || '.html' AS url,
         'https://shop.example/catalogue/item_' || p_partkey || '/index.html' AS source_url,
         'https://shop.example/media/' || p_partkey || '.jpg' AS image_url,
         trim(p_name) AS title, (p_partkey % 5 + 1)::BIGINT AS rating,
         CASE WHEN p_partkey % 13 <> 0 THEN 'In stock' END AS availability,
         (p_partkey % 90 + 10) || '.' || lpad((p_partkey % 100)::VARCHAR, 2, '0') AS digits,
         CASE WHEN p_partkey % 29 = 0 THEN 'missing title anchor in product listing'
              WHEN p_partkey % 31 = 0 THEN 'missing detail link in product listing'
              WHEN p_partkey % 17 = 0 THEN 'missing price in product listing'
              WHEN p_partkey % 19 = 0 THEN 'cannot parse price from ''£N/A'''
              WHEN p_partkey % 23 = 0 THEN 'no recognized currency symbol in '''
                || (p_partkey % 90 + 10) || '.' || lpad((p_partkey % 100)::VARCHAR, 2, '0') || ''''
              END AS reason
  FROM part WHERE (p_partkey // 20) % 11 <> 10 AND (p_partkey // 20) % 13 <> 12)"""


@query(
    f"""WITH {ITEMS}
    SELECT page_ord::BIGINT AS page_ord, site_id, source_url, title, round(digits::DOUBLE, 6) AS price,
           'GBP' AS currency, availability, rating, image_url,
           CASE WHEN availability IS NULL THEN 0.75 ELSE 1.0 END::DOUBLE AS completeness_score,
           sha256(site_id || ':' || source_url) AS record_id,
           sha256(title || '|' || digits || '|' || coalesce(availability, 'None')) AS content_hash
    FROM items WHERE reason IS NULL"""
)
def listing_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = extract.extract(listing_pages(spark, sf_dir))
    records = extract.records_of(extracted, shop_runs(spark, sf_dir))
    attributes = F.from_json("attributes", "rating bigint, image_url string")
    return records.select(
        F.col("page_ord").cast("long").alias("page_ord"),
        "site_id",
        "source_url",
        "title",
        F.round(F.col("price").cast("double"), 6).alias("price"),
        "currency",
        "availability",
        attributes["rating"].alias("rating"),
        attributes["image_url"].alias("image_url"),
        "completeness_score",
        "record_id",
        "content_hash",
    )


@query(f"WITH {ITEMS} SELECT site_id, url AS source_url, reason FROM items WHERE reason IS NOT NULL")
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = extract.rejects_of(extract.extract(listing_pages(spark, sf_dir)))
    return rejects.select("site_id", "source_url", "reason")


PAGES = """
lists AS (
  SELECT DISTINCT p_partkey // 20 AS page_ord, 'shop_' || (p_partkey // 20) % 5 AS site_id,
         'https://shop.example/catalogue/page-' || p_partkey // 20 || '.html' AS url FROM part),
errors AS (
  SELECT site_id, url, CASE WHEN page_ord % 11 = 10 THEN 'unexpected status 503 fetching ' || url
                            ELSE 'no product listings found on ' || url END AS reason
  FROM lists WHERE page_ord % 11 = 10 OR page_ord % 13 = 12)"""


@query(f"WITH {PAGES} SELECT * FROM errors")
def page_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = extract.page_errors_of(extract.extract(listing_pages(spark, sf_dir)))
    return errors.select("site_id", "url", "reason")


@query(
    f"""WITH {PAGES}
    SELECT site_id, strftime(TIMESTAMP '2026-01-01' + INTERVAL 1 SECOND * page_ord, '%Y-%m-%d') AS dt,
           count(*) AS pages, count(*) - count(reason) AS matched,
           round(1 - count(reason)::DOUBLE / count(*), 6) AS share,
           count(reason) * 10 <= count(*) AS healthy,
           (count(*) - count(reason)) || ' of ' || count(*) || ' pages matched' AS message
    FROM lists LEFT JOIN errors USING (site_id, url) GROUP BY 1, 2"""
)
def extractor_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    health = extract.extractor_health(extract.extract(listing_pages(spark, sf_dir)), min_share=0.9)
    return health.withColumns(
        {"dt": F.col("dt").cast("string"), "share": F.round("share", 6)}
    )


@query(
    """SELECT doc_id AS page_ord,
           CASE WHEN doc_id % 15 = 0 OR doc_id % 10 = 0 THEN 'reject' ELSE 'record' END AS kind,
           CASE WHEN doc_id % 15 = 0 THEN 'missing quote text'
                WHEN doc_id % 10 = 0 THEN 'missing author' END AS reason,
           CASE WHEN NOT (doc_id % 15 = 0 OR doc_id % 10 = 0) THEN
             sha256(trim(text, chr(10) || ' ') || '|' || source) END AS content_hash,
           CASE WHEN NOT (doc_id % 15 = 0 OR doc_id % 10 = 0) THEN
             sha256('quotes:https://quotes.example/' || doc_id || ':' || trim(text, chr(10) || ' '))
             END AS record_id,
           lang || ',all' AS tags
    FROM documents"""
)
def quote_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = extract.extract(quote_pages(spark, sf_dir))
    kept = F.col("kind") == "record"
    tags = F.from_json("attributes", "author string, tags array<string>")["tags"]
    return extracted.select(
        "page_ord",
        "kind",
        "reason",
        F.when(kept, F.col("content_hash")).alias("content_hash"),
        F.when(kept, F.col("record_id")).alias("record_id"),
        F.array_join(tags, ",").alias("tags"),
    )


LEADS = r"""
lines AS (
      SELECT doc_id, source, string_split(text, chr(10)) AS raw FROM documents),
    cleaned AS (
      SELECT doc_id, source, list_transform(range(1, len(raw) + 1), lambda i: trim(regexp_replace(regexp_replace(
        CASE WHEN i < len(raw) THEN trim(raw[i]) || ' ,' ELSE trim(raw[i]) END,
        '\s+([,.;:])', '\1', 'g'), '\s+', ' ', 'g'))) AS ps
      FROM lines),
    leads AS (SELECT doc_id, source, list_filter(ps, lambda p: length(p) >= 80)[1] AS lead FROM cleaned)"""


@query(
    f"""WITH {LEADS}
    SELECT doc_id AS page_ord, CASE WHEN lead IS NULL THEN 'reject' ELSE 'record' END AS kind,
           CASE WHEN lead IS NULL THEN 'no substantial lead paragraph found' END AS reason,
           CASE WHEN lead IS NOT NULL THEN sha256('Doc ' || doc_id || '|' || lead) END AS content_hash,
           CASE WHEN lead IS NOT NULL THEN CASE WHEN doc_id % 7 = 0 THEN 0.5 ELSE 1.0 END END::DOUBLE
             AS completeness_score,
           CASE WHEN doc_id % 7 <> 0 THEN source END AS short_description
    FROM leads"""
)
def article_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = extract.extract(article_pages(spark, sf_dir))
    kept = F.col("kind") == "record"
    attributes = F.from_json("attributes", "short_description string, summary string")
    return extracted.select(
        "page_ord",
        "kind",
        "reason",
        F.when(kept, F.col("content_hash")).alias("content_hash"),
        F.when(kept, F.col("completeness_score")).alias("completeness_score"),
        attributes["short_description"].alias("short_description"),
    )
