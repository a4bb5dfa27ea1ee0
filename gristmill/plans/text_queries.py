"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import functions as M
from gristmill.plans.adapters import naive, table
from gristmill.plans.catalog import query

RAW_PRICE = """
raw AS (
  SELECT p_partkey, CASE p_partkey % 9
    WHEN 0 THEN '£' || p_partkey || '.50'
    WHEN 1 THEN ' $1,' || lpad((p_partkey % 1000)::VARCHAR, 3, '0') || '.0 '
    WHEN 2 THEN '-' || p_partkey
    WHEN 3 THEN 'call us'
    WHEN 4 THEN '€ 00' || p_partkey || '.'
    WHEN 5 THEN '1.2.' || p_partkey
    WHEN 6 THEN '.' || p_partkey
    WHEN 7 THEN p_partkey || ' £'
    ELSE '' END AS raw
  FROM part)"""


def _raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    thousand = F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0")
    forms = [
        F.concat(F.lit("£"), key, F.lit(".50")),
        F.concat(F.lit(" $1,"), thousand, F.lit(".0 ")),
        F.concat(F.lit("-"), key),
        F.lit("call us"),
        F.concat(F.lit("€ 00"), key, F.lit(".")),
        F.concat(F.lit("1.2."), key),
        F.concat(F.lit("."), key),
        F.concat(key, F.lit(" £")),
        F.lit(""),
    ]
    raw = F.get(F.array(*forms), (F.col("p_partkey") % 9).cast("int"))
    return part.select("p_partkey", raw.alias("raw"))


@query(
    f"""WITH {RAW_PRICE}, kept AS (
      SELECT p_partkey, raw, regexp_replace(raw, '[^0-9.]', '', 'g') AS k FROM raw)
    SELECT p_partkey, raw,
           CASE WHEN regexp_full_match(k, '[0-9]+\\.?[0-9]*|\\.[0-9]+') THEN
             CASE WHEN regexp_extract(k, '^0*([0-9]*)', 1) = '' THEN '0'
                  ELSE regexp_extract(k, '^0*([0-9]*)', 1) END
             || CASE WHEN regexp_extract(k, '\\.([0-9]+)$', 1) = '' THEN ''
                     ELSE '.' || regexp_extract(k, '\\.([0-9]+)$', 1) END END AS digits,
           round(TRY_CAST(CASE WHEN k NOT IN ('', '.') THEN k END AS DOUBLE), 6) AS price
    FROM kept"""
)
def price_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("raw")
    return _raw_prices(spark, sf_dir).select(
        "p_partkey",
        "raw",
        M.price_digits(raw).alias("digits"),
        F.round(M.decimal_price(raw).cast("double"), 6).alias("price"),
    )


@query(
    f"""WITH {RAW_PRICE}
    SELECT p_partkey, CASE WHEN trim(raw) LIKE '£%' THEN 'GBP' WHEN trim(raw) LIKE '$%' THEN 'USD'
                           WHEN trim(raw) LIKE '€%' THEN 'EUR' END AS currency
    FROM raw"""
)
def currency_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_prices(spark, sf_dir).select(
        "p_partkey", M.currency_code(F.col("raw")).alias("currency")
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN
         date_trunc('second', o_orderdate + INTERVAL 1 SECOND * (o_orderkey % 86400)) END AS parsed
    FROM orders"""
)
def datetime_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates printed in a site's format, some of them broken, and parsed again."""
    orders = table(spark, sf_dir, "orders")
    at = F.timestamp_add("SECOND", (F.col("o_orderkey") % 86400).cast("int"), F.col("o_orderdate"))
    shown = F.concat(F.lit(" "), F.date_format(at, "d/M/yyyy HH:mm:ss"))
    broken = F.when(F.col("o_orderkey") % 10 == 0, F.concat(shown, F.lit("?"))).otherwise(shown)
    parsed = M.parse_datetime(broken, "%d/%m/%Y %H:%M:%S")
    return naive(orders.select("o_orderkey", parsed.alias("parsed")))


@query(
    """SELECT doc_id, sha256(source || ':https://docs.example/' || doc_id) AS record_id,
           sha256(text || '|' || coalesce(CASE WHEN doc_id % 5 <> 0 THEN lang END, 'None'))
             AS content_hash
    FROM documents"""
)
def hash_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    url = F.concat(F.lit("https://docs.example/"), F.col("doc_id").cast("string"))
    lang = F.when(F.col("doc_id") % 5 != 0, F.col("lang"))
    return docs.select(
        "doc_id",
        M.record_id(F.col("source"), url).alias("record_id"),
        M.content_hash(F.col("text"), lang).alias("content_hash"),
    )


@query(
    """SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
           replace(text, chr(10), ' [ é' || doc_id || '] ' || chr(10)),
           '\\[[\\s\\p{Z}]*[\\p{L}\\p{N}\\p{M}_]+[\\s\\p{Z}]*\\]', '', 'g'),
           '[\\s\\p{Z}]+([,.;:])', '\\1', 'g'),
           '[\\s\\p{Z}]+', ' ', 'g'), '^ | $', '', 'g')) AS cleaned
    FROM documents"""
)
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, with a citation marker put at the end of every line."""
    docs = table(spark, sf_dir, "documents")
    marker = F.concat(F.lit(" [ é"), F.col("doc_id").cast("string"), F.lit("] \n"))
    cited = F.replace("text", F.lit("\n"), marker)
    return docs.select("doc_id", F.sha2(M.clean_article_text(cited), 256).alias("cleaned"))


@query(
    """SELECT doc_id, sha256(trim(nfc_normalize('file 12 A' || text || ' fin'), chr(10) || ' '))
         AS normalized
    FROM documents"""
)
def nfkc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents between ligatures, full-width letters and odd spaces."""
    docs = table(spark, sf_dir, "documents")
    framed = F.concat(F.lit("　ﬁle １２ Ａ"), F.col("text"), F.lit(" ﬁn \n"))
    return docs.select("doc_id", F.sha2(M.nfkc_strip(framed), 256).alias("normalized"))


@query(
    """SELECT doc_id, sha256('https://wiki.example/' || replace(url_encode(
           source || '/(' || lang || ')*~' || text), '%2F', '/')) AS url
    FROM documents"""
)
def frontier_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target per document, the title being built from its whole text."""
    from gristmill.operators.frontier import title_targets

    docs = table(spark, sf_dir, "documents")
    title = F.concat("source", F.lit("/("), "lang", F.lit(")*~"), "text")
    titles = docs.select(
        F.col("source").alias("site_id"),
        F.col("doc_id").alias("ordinal"),
        F.lit("https://wiki.example/").alias("base_url"),
        title.alias("title"),
    )
    targets = title_targets(titles)
    return targets.select(F.col("ordinal").alias("doc_id"), F.sha2("url", 256).alias("url"))


@query(
    """SELECT site_id, ordinal, url, max_scroll_rounds,
           regexp_extract(url, '^https?://([^/]*)', 1) AS domain
    FROM (
      SELECT p_brand AS site_id, p - 1 AS ordinal, 0 AS max_scroll_rounds,
             'https://' || p_partkey || '.example/list/page-' || p || '.html' AS url
      FROM (SELECT *, unnest(range(1, p_size + 1)) AS p FROM part))"""
)
def frontier_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A paged site per part, with as many pages as the part is large."""
    from gristmill.operators.frontier import paged_targets

    part = table(spark, sf_dir, "part")
    host = F.concat(F.lit("https://"), F.col("p_partkey").cast("string"))
    templates = part.select(
        F.col("p_brand").alias("site_id"),
        F.concat(host, F.lit(".example/list/page-{page}.html")).alias("template"),
        F.lit(1).alias("first_page"),
        F.col("p_size").alias("last_page"),
        F.lit(0).alias("max_scroll_rounds"),
    )
    targets = paged_targets(templates)
    return targets.withColumn("domain", M.authority(F.col("url")))


@query(
    """SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/up/' || page_id AS resolved,
           url AS unchanged
    FROM pages"""
)
def resolve_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    relative = F.concat(F.lit(" /x/../up/"), F.col("page_id").cast("string"), F.lit("\n"))
    return pages.select(
        "page_id",
        M.resolve_url(relative, F.col("url")).alias("resolved"),
        M.resolve_url(F.col("url"), F.lit("https://other.example/a/")).alias("unchanged"),
    )


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%dT%H%M%SZ') || '-' ||
           substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8) AS run_id,
           strftime(o_orderdate, '%Y-%m-%d') AS run_date
    FROM orders"""
)
def run_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    token = F.sha2(F.col("o_orderkey").cast("string"), 256)
    return orders.select(
        "o_orderkey",
        M.run_id_from(F.col("o_orderdate"), token).alias("run_id"),
        F.to_date("o_orderdate").cast("string").alias("run_date"),
    )
