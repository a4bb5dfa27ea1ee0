"""Views that present the driver's tables as crawl data. Every row of a table takes part; columns
get holes and errors by arithmetic on the key, so that each operator has work to do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.session import small_table

KEY_TIME = "timestamp'2026-01-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with its times as UTC instants."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    times = [c for c, kind in df.dtypes if kind == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in times}) if times else df


def naive(df: DataFrame) -> DataFrame:
    """Times of a result as plain UTC wall-clock values."""
    times = [c for c, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df


def escaped(c: Column) -> Column:
    """Text as it stands in HTML."""
    for raw, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(reference))
    return c


def every_nth(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` as records of 25 sites; the site Brand#9 has no holes."""
    part = table(spark, sf_dir, "part")
    holed = F.col("p_brand") != "Brand#9"
    title = F.when(holed & every_nth("p_partkey", 101), "").otherwise(F.col("p_name"))
    price = (
        F.when(holed & every_nth("p_partkey", 89), None)
        .when(holed & every_nth("p_partkey", 83), -F.col("p_retailprice"))
        .otherwise(F.col("p_retailprice"))
    )
    currency = F.when(~(holed & every_nth("p_partkey", 97)), "USD")
    out = part.select(
        "p_partkey",
        "p_size",
        F.col("p_brand").alias("site_id"),
        F.lit("r1").alias("run_id"),
        title.alias("title"),
        price.alias("price"),
        currency.alias("currency"),
        F.sha2(F.concat("p_name", F.lit("|"), F.col("p_size").cast("string")), 256).alias(
            "content_hash"
        ),
    )
    present = sum(
        (c.cast("int") for c in (F.col("title") != "", F.col("price").isNotNull())),
        F.col("currency").isNotNull().cast("int"),
    )
    return out.withColumn("completeness_score", present / F.lit(3.0))


def fetch_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as fetch outcomes of ten domains: errors and rate limits fail."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.concat(F.lit("d"), (F.col("user_id") % 10).cast("string")).alias("domain"),
        "ts",
        F.col("event_id").alias("seq"),
        F.col("event_type").isin("error", "signup").alias("failed"),
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as fetch attempts: each user's events of a day are attempts at one URL."""
    from pyspark.sql import Window

    events = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    turn = Window.partitionBy("user_id", day).orderBy("ts", "event_id")
    kind = F.col("event_type")
    status = F.when(kind == "error", 503).when(kind == "signup", 429).when(kind == "click", 404)
    header = (
        F.when(F.col("event_id") % 5 == 0, F.floor("value").cast("string"))
        .when(
            F.col("event_id") % 5 == 1,
            F.concat(
                F.date_format(F.expr("ts + interval 30 seconds"), "EEE, dd MMM yyyy HH:mm:ss"),
                F.lit(" GMT"),
            ),
        )
        .when(F.col("event_id") % 5 == 2, "soon")
        .when(F.col("event_id") % 5 == 4, "7200")
    )
    name = F.when(F.col("event_id") % 2 == 0, "Retry-After").otherwise("retry-after")
    return events.select(
        F.col("event_id").alias("seq"),
        "ts",
        F.lit("s").alias("site_id"),
        F.concat(F.lit("d"), (F.col("user_id") % 10).cast("string")).alias("domain"),
        F.concat(
            F.lit("u"), F.col("user_id").cast("string"), F.lit("/"), day.cast("string")
        ).alias("url"),
        F.row_number().over(turn).alias("attempt_no"),
        F.when(kind != "view", status.otherwise(200)).alias("status_code"),
        F.when(every_nth("event_id", 50), "robots_disallowed")
        .when(kind == "view", "fetch_error")
        .alias("error_kind"),
        F.when(header.isNotNull(), F.create_map(name, header))
        .otherwise(F.create_map(F.lit("server"), F.lit("x")))
        .alias("headers"),
        F.col("value").alias("latency_ms"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` as records whose content is the whole text."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        F.col("source").alias("site_id"),
        F.sha2("text", 256).alias("content_hash"),
        F.concat(F.lit("r"), (F.col("doc_id") % 2).cast("string")).alias("run_id"),
        F.expr(
            f"{KEY_TIME} + make_dt_interval(cast(doc_id % 2 as int) * 30)"
        ).alias("started_at"),
    )


def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` as fetched pages of seven shapes: shells, challenges, failures, content."""
    docs = table(spark, sf_dir, "documents")
    text = escaped(F.col("text"))

    def page(before: str, after: str) -> Column:
        return F.concat(F.lit(before), text, F.lit(after))

    shape = F.col("doc_id") % 7
    body = (
        F.when(
            shape == 0,
            page('<html><body><div id="root">loading...</div><script>', "</script></body></html>"),
        )
        .when(
            shape == 1,
            page("<html><head><title>Just a moment</title></head><body><p>", "</p></body></html>"),
        )
        .when(shape == 2, page("<html><body><h1>Just a moment...</h1><p>", "</p></body></html>"))
        .when(shape == 3, F.lit("<html><head></head></html>"))
        .when(shape == 4, F.lit("<html><body></body></html>"))
        .when(shape == 5, F.lit("{}"))
        .otherwise(page("<html><body>\n <p>", "</p> </body></html>"))
    )
    return docs.select(
        F.col("source").alias("site_id"),
        F.lit("r1").alias("run_id"),
        F.concat(F.lit("https://docs.example/"), F.col("doc_id").cast("string")).alias("url"),
        "doc_id",
        F.when(shape == 4, 503).otherwise(200).alias("status_code"),
        F.create_map(F.lit("server"), F.lit("x")).alias("headers"),
        F.encode(body, "UTF-8").alias("body"),
        F.expr(f"{KEY_TIME}").alias("fetched_at"),
        F.when(shape == 5, "application/json").when(shape == 6, "text/html").alias("content_type"),
    )


def rendered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered copies of every second document page."""
    docs = table(spark, sf_dir, "documents").filter("doc_id % 2 = 0")
    body = F.concat(F.lit("<html><body><p>"), escaped(F.col("text")), F.lit("</p></body></html>"))
    return docs.select(
        F.col("source").alias("site_id"),
        F.lit("r1").alias("run_id"),
        F.concat(F.lit("https://docs.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit(200).alias("status_code"),
        F.create_map(F.lit("server"), F.lit("browser")).alias("headers"),
        F.encode(body, "UTF-8").alias("body"),
        F.expr(f"{KEY_TIME} + interval 5 seconds").alias("fetched_at"),
        F.lit("text/html").alias("content_type"),
    )


RATING_WORDS = ("One", "Two", "Three", "Four", "Five")


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` as product listings, twenty to a page, over five sites; with missing and malformed
    fields, failed pages (status 503) and pages without listings."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    href = F.concat(F.lit("item_"), key, F.lit("/index.html"))
    word = F.element_at(
        F.array(*[F.lit(w) for w in RATING_WORDS]), (F.col("p_partkey") % 5 + 1).cast("int")
    )
    amount = F.concat(
        (F.col("p_partkey") % 90 + 10).cast("string"),
        F.lit("."),
        F.lpad((F.col("p_partkey") % 100).cast("string"), 2, "0"),
    )
    price = (
        F.when(every_nth("p_partkey", 17), "")
        .when(every_nth("p_partkey", 19), '<p class="price_color">£N/A</p>')
        .when(
            every_nth("p_partkey", 23),
            F.concat(F.lit('<p class="price_color">'), amount, F.lit("</p>")),
        )
        .otherwise(F.concat(F.lit('<p class="price_color">£'), amount, F.lit("</p>")))
    )
    title = F.when(every_nth("p_partkey", 29), "").otherwise(
        F.concat(F.lit(' title="'), escaped(F.col("p_name")), F.lit('"'))
    )
    link = F.when(every_nth("p_partkey", 31), "").otherwise(
        F.concat(F.lit(' href="'), href, F.lit('"'))
    )
    stock = F.when(every_nth("p_partkey", 13), "").otherwise(
        '<p class="instock availability"><i class="icon-ok"></i>\n   In stock\n</p>'
    )
    article = F.concat(
        F.lit('<li><article class="product_pod"><div class="image_container"><img src="../media/'),
        key,
        F.lit('.jpg"></div><p class="star-rating '),
        word,
        F.lit('"></p><h3><a'),
        link,
        title,
        F.lit(">...</a></h3><div>"),
        price,
        stock,
        F.lit("</div></article></li>"),
    )
    page_ord = F.floor(F.col("p_partkey") / 20).cast("int")
    pages = part.groupBy(page_ord.alias("page_ord")).agg(
        F.sort_array(F.collect_list(F.struct("p_partkey", article.alias("html")))).alias("items")
    )
    listing = F.concat(
        F.lit("<html><body><ol>"), F.array_join("items.html", ""), F.lit("</ol></body></html>")
    )
    body = F.when(F.col("page_ord") % 13 == 12, "<html><body>none</body></html>").otherwise(listing)
    return pages.select(
        F.concat(F.lit("shop_"), (F.col("page_ord") % 5).cast("string")).alias("site_id"),
        F.lit("r1").alias("run_id"),
        "page_ord",
        F.concat(
            F.lit("https://shop.example/catalogue/page-"),
            F.col("page_ord").cast("string"),
            F.lit(".html"),
        ).alias("url"),
        F.when(F.col("page_ord") % 11 == 10, 503).otherwise(200).alias("status_code"),
        F.create_map(F.lit("server"), F.lit("x")).alias("headers"),
        F.encode(body, "UTF-8").alias("body"),
        F.expr(f"{KEY_TIME} + make_dt_interval(0, 0, 0, page_ord)").alias("fetched_at"),
        F.lit("text/html").alias("content_type"),
        F.lit("product_listing").alias("module"),
    )


def _shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    page_ord = F.floor(F.col("p_partkey") / 20).cast("int")
    site = F.concat(F.lit("shop_"), (page_ord % 5).cast("string"))
    return table(spark, sf_dir, "part").select(site.alias("site_id")).distinct()


def shop_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows of the listing sites."""
    return _shops(spark, sf_dir).select(
        F.col("site_id").alias("id"),
        F.lit("product_listing").alias("module"),
        F.lit(True).alias("enabled"),
        F.lit("strict").alias("dq_profile"),
    )


def shop_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per listing site."""
    return _shops(spark, sf_dir).select(
        F.lit("r1").alias("run_id"),
        "site_id",
        F.expr(KEY_TIME).alias("started_at"),
        F.lit("v1").alias("scraper_version"),
        F.lit("local").alias("backend"),
    )


def all_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings, quotes and articles as one table of raw pages."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            pages(spark, sf_dir).withColumns({"page_ord": F.col("page_ord").cast("int"), "body": F.col("body").cast("binary")})
            for pages in (listing_pages, quote_pages, article_pages)
        ],
    )


def all_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows of the sites of `all_pages`."""
    more = small_table(
        spark, [("quotes", "quote", True, "strict"), ("articles", "article", True, "strict")],
        "id string, module string, enabled boolean, dq_profile string",
    )
    return shop_registry(spark, sf_dir).unionByName(more)


def all_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per site of `all_pages`."""
    runs = all_sites(spark, sf_dir).select(
        F.lit("r1").alias("run_id"), F.col("id").alias("site_id"), F.expr(KEY_TIME).alias("started_at"),
        F.lit("v1").alias("scraper_version"), F.lit("local").alias("backend"),
    )
    return runs


def quote_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` as quote pages, the whole text being the quote; some lack text or author."""
    docs = table(spark, sf_dir, "documents")
    text = F.when(every_nth("doc_id", 15), "").otherwise(escaped(F.col("text")))
    author = F.when(every_nth("doc_id", 10), " ").otherwise(F.col("source"))
    body = F.concat(
        F.lit('<html><body><div class="quote"><span class="text">'),
        text,
        F.lit('</span><span>by <small class="author">'),
        author,
        F.lit('</small></span><div class="tags">Tags: <a class="tag" href="/t">'),
        F.col("lang"),
        F.lit('</a> <a class="tag">all</a></div></div></body></html>'),
    )
    return docs.select(
        F.lit("quotes").alias("site_id"),
        F.lit("r1").alias("run_id"),
        F.col("doc_id").alias("page_ord"),
        F.concat(F.lit("https://quotes.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit(200).alias("status_code"),
        body.alias("body"),
        F.expr(KEY_TIME).alias("fetched_at"),
        F.lit("quote").alias("module"),
    )


def article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` as articles, each line of the text a paragraph with a citation marker."""
    docs = table(spark, sf_dir, "documents")
    description = F.when(every_nth("doc_id", 7), "").otherwise(
        F.concat(F.lit('<div class="shortdescription">'), F.col("source"), F.lit("</div>"))
    )
    paragraphs = F.replace(escaped(F.col("text")), F.lit("\n"), F.lit(" <b>[1]</b> , </p><p>"))
    body = F.concat(
        F.lit('<html><body><h1 id="firstHeading">Doc '),
        F.col("doc_id").cast("string"),
        F.lit("</h1>"),
        description,
        F.lit('<div id="mw-content-text"><p>'),
        paragraphs,
        F.lit("</p></div></body></html>"),
    )
    return docs.select(
        F.lit("articles").alias("site_id"),
        F.lit("r1").alias("run_id"),
        F.col("doc_id").alias("page_ord"),
        F.concat(F.lit("https://wiki.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit(200).alias("status_code"),
        body.alias("body"),
        F.expr(KEY_TIME).alias("fetched_at"),
        F.lit("article").alias("module"),
    )


def robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A robots answer for every origin in `pages`, of five kinds by the length of the origin."""
    from gristmill.functions import origin

    origins = table(spark, sf_dir, "pages").select(origin(F.col("url")).alias("origin")).distinct()
    kind = F.length("origin") % 5
    body = F.when(
        kind == 0,
        "User-agent: other\nDisallow: /\n\nUser-agent: *\nAllow: /fr/\nDisallow: /en/\nCrawl-delay: 5\n",
    ).when(kind == 1, "User-agent: millbot\nDisallow: /en/9\nDisallow: /es\n\nUser-agent: *\nDisallow: /\n")
    status = F.when(kind == 2, 404).when(kind == 3, 500).when(kind < 2, 200)
    return origins.select("origin", status.alias("status_code"), body.alias("body"))
