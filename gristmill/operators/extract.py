"""Record extraction: raw pages -> records, rejects and page errors.

The Python stage only finds the raw strings of each container (`harvest`). Normalizing, checking,
hashing and scoring happen in Catalyst on its output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from gristmill import fixed_values as V
from gristmill.functions import (
    clean_article_text,
    content_hash,
    currency_code,
    price_digits,
    quoted,
    record_id,
)
from gristmill.functions.money import PRICE_TYPE
from gristmill.operators.markup import Harvester, Rule, Spec
from gristmill.schemas import RECORD_COLUMNS
from gristmill.session import bounded_batches, spread

# ---- fixed values: page kinds and their selectors ------------------------------------------
PRODUCT_LISTING = Spec(
    "product_listing",
    "article.product_pod",
    (
        Rule("title", "h3 > a", "@title", form="nfkc"),
        Rule("title_raw", "h3 > a", "@title"),
        Rule("href", "h3 > a", "@href", form="url"),
        Rule("href_raw", "h3 > a", "@href"),
        Rule("price", "p.price_color"),
        Rule("availability", "p.instock.availability", form="nfkc"),
        Rule("rating", "p.star-rating", "@class"),
        Rule("image", "div.image_container img", "@src", form="url"),
    ),
    keep_fragment=True,
)
QUOTE = Spec(
    "quote",
    "div.quote",
    (
        Rule("text_raw", "span.text"),
        Rule("text", "span.text", form="nfkc"),
        Rule("author_raw", "small.author"),
        Rule("author", "small.author", form="nfkc"),
        Rule("tags", "div.tags a.tag", many=True, form="nfkc"),
    ),
    keep_fragment=True,
)
ARTICLE = Spec(
    "article",
    "",
    (
        Rule("heading_raw", "#firstHeading"),
        Rule("heading", "#firstHeading", form="nfkc"),
        Rule("short_description", ".shortdescription", form="nfkc"),
        Rule("paragraphs", "#mw-content-text p", "joined", many=True),
    ),
)

# Rows of a batch of pages go out in parts, once so many characters were read or rows found.
PART_CHARS = 1 << 20
PART_ROWS = 1000


def _found_rows(
    carried: pa.RecordBatch, rows: list, ordinals: list, found: list, fragments: list
) -> pa.RecordBatch:
    taken = carried.take(pa.array(rows, pa.int32()))
    return pa.RecordBatch.from_arrays(
        taken.columns
        + [
            pa.array(ordinals, pa.int32()),
            pa.array(found, pa.map_(pa.string(), pa.list_(pa.string()))),
            pa.array(fragments, pa.string()),
        ],
        names=carried.schema.names + ["element_ord", "found", "fragment"],
    )


def harvest(
    pages: DataFrame,
    spec: Spec | Mapping[str, Spec],
    *,
    keep: Sequence[str],
    body: str = "body",
    route: str = "module",
) -> DataFrame:
    """One row per container in each page, with the strings the rules found.

    With several specs, each page is read by the one its `route` column names; pages without a
    spec yield nothing. Adds `element_ord` (order in the document, null for a page without any
    container), `found` (values by rule name, in order) and `fragment` (source of the container).
    Reads `url` and `body` (text or UTF-8 bytes) and carries the `keep` columns along. The session's
    Arrow batches are bounded by rows and bytes.
    """
    bounded_batches(pages.sparkSession)
    many = not isinstance(spec, Spec)
    chosen = F.col(route) if many else F.lit(spec.name)
    source = pages.select(
        *keep, F.col("url").alias("_url"), F.col(body).alias("_body"), chosen.alias("_spec")
    )
    schema = StructType(
        [source.schema[name] for name in keep]
        + [
            StructField("element_ord", IntegerType()),
            StructField("found", MapType(StringType(), ArrayType(StringType()))),
            StructField("fragment", StringType()),
        ]
    )
    kept = list(keep)
    specs = dict(spec) if many else {spec.name: spec}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        harvesters = {name: Harvester(one) for name, one in specs.items()}
        for batch in batches:
            # the bodies stay out of what is taken once per container
            carried = batch.select(kept)
            columns = [batch.column(name) for name in ("_url", "_body", "_spec")]
            rows, ordinals, found, fragments, size = [], [], [], [], 0
            for row in range(batch.num_rows):
                name = columns[2][row].as_py()
                if name not in harvesters:
                    continue
                url, html = columns[0][row].as_py(), columns[1][row].as_py()
                if isinstance(html, bytes):
                    html = html.decode("utf-8", "replace")
                boxes = harvesters[name].harvest(html or "", url or "")
                for ordinal, (values, fragment) in enumerate(boxes):
                    rows.append(row)
                    ordinals.append(ordinal)
                    found.append(list(values.items()))
                    fragments.append(fragment)
                    size += len(fragment)
                if not boxes:
                    rows.append(row)
                    ordinals.append(None)
                    found.append([])
                    fragments.append(None)
                size += len(html or "")
                if size >= PART_CHARS or len(rows) >= PART_ROWS:
                    yield _found_rows(carried, rows, ordinals, found, fragments)
                    rows, ordinals, found, fragments, size = [], [], [], [], 0
            if rows:
                yield _found_rows(carried, rows, ordinals, found, fragments)

    return spread(source).mapInArrow(run, schema)


HARVEST_ROW = "element_ord int, found map<string,array<string>>, fragment string"


def register_harvest(
    spark: SparkSession, specs: Mapping[str, Spec] | None = None, name: str = "harvest"
) -> None:
    """Make the harvest a SQL table function for lateral joins:
    `SELECT p.url, h.* FROM pages p, LATERAL harvest(p.body, p.url, 'quote') h`."""
    chosen = specs or {kind: one.spec for kind, one in EXTRACTORS.items()}

    class Harvest:
        def __init__(self):
            self._harvesters = {kind: Harvester(spec) for kind, spec in chosen.items()}

        def eval(self, body, url: str, kind: str):
            if isinstance(body, (bytes, bytearray)):
                body = bytes(body).decode("utf-8", "replace")
            boxes = self._harvesters[kind].harvest(body or "", url or "")
            for ordinal, (values, fragment) in enumerate(boxes):
                yield ordinal, values, fragment

    spark.udtf.register(name, F.udtf(Harvest, returnType=HARVEST_ROW))


def first(rule: str) -> Column:
    """First value a rule found, or null."""
    return F.get(F.col("found")[rule], F.lit(0))


def every(rule: str) -> Column:
    """All values a rule found."""
    return F.coalesce(F.col("found")[rule], F.array().cast("array<string>"))


def present_share(*present: Column) -> Column:
    """Completeness: the share of required fields that are there."""
    hits = sum((F.coalesce(p, F.lit(False)).cast("int") for p in present), F.lit(0))
    return hits / F.lit(float(len(present)))


def star_rating(css_class: Column) -> Column:
    """1 to 5 from the first rating word among the class names, else null."""
    words = F.create_map(*[F.lit(x) for pair in V.RATING_BY_WORD.items() for x in pair])
    ratings = F.transform(F.split(css_class, r"\s+"), lambda word: F.try_element_at(words, word))
    return F.get(F.filter(ratings, lambda r: r.isNotNull()), F.lit(0))


def lead_paragraph(paragraphs: Column) -> Column:
    """First paragraph that is long enough once cleaned, else null."""
    cleaned = F.transform(paragraphs, clean_article_text)
    return F.get(F.filter(cleaned, lambda p: F.length(p) >= V.MIN_LEAD_CHARS), F.lit(0))


def _web_url(url: Column) -> Column:
    """Whether a record's URL can be stored: http(s) with a host."""
    return F.coalesce(url.rlike(r"(?i)^https?://[^/?#\s]+"), F.lit(False))


@dataclass(frozen=True)
class Extractor:
    """How one kind of page becomes records. Registered per site, the plugin of this engine."""

    spec: Spec
    no_container: str
    """Page error for a page without the container (or, for a whole page, its first rule)."""
    fetch_strategy: str
    fields: Callable[[], dict[str, Column]]
    """Cleaned values in terms of `found`. Each is computed once, however often it is used."""
    derive: Callable[[], dict[str, Column]]
    """Record columns in terms of the fields; among them `reason` (null for a good record)."""


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) == ""


def _absent(data_type: str | DataType) -> Column:
    return F.lit(None).cast(data_type)


def _product_fields() -> dict[str, Column]:
    return {
        "title_raw": first("title_raw"),
        "href_raw": first("href_raw"),
        "title": first("title"),
        "source_url": first("href"),
        "price_text": first("price"),
        "price_digits": price_digits(first("price")),
        "currency": currency_code(first("price")),
        "availability": first("availability"),
        "rating": star_rating(first("rating")),
        "image_url": F.nullif(first("image"), F.lit("")),
    }


def _product_columns() -> dict[str, Column]:
    digits, price_text = F.col("price_digits"), F.col("price_text")
    reason = (
        F.when(_blank("title_raw"), V.REASON_NO_TITLE)
        .when(_blank("href_raw"), V.REASON_NO_LINK)
        .when(price_text.isNull(), V.REASON_NO_PRICE)
        .when(digits.isNull(), F.concat(F.lit(V.REASON_BAD_PRICE), quoted(price_text)))
        .when(
            F.col("currency").isNull(), F.concat(F.lit(V.REASON_BAD_CURRENCY), quoted(price_text))
        )
        .when(~_web_url(F.col("source_url")), "invalid source_url")
    )
    return {
        "reason": reason,
        "payload": F.create_map(F.lit("article_html"), F.col("fragment")),
        "price": digits.try_cast(PRICE_TYPE),
        "attributes": F.to_json(
            F.struct("rating", "image_url"), {"ignoreNullFields": "false"}
        ),
        "completeness_score": present_share(
            F.col("title") != "",
            digits.isNotNull(),
            F.col("currency").isNotNull(),
            F.col("availability").isNotNull(),
        ),
        "record_id": record_id(F.col("site_id"), F.col("source_url")),
        "content_hash": content_hash(F.col("title"), digits, F.col("availability")),
    }


def _quote_fields() -> dict[str, Column]:
    return {
        "title_raw": first("text_raw"),
        "author_raw": first("author_raw"),
        "title": first("text"),
        "author": first("author"),
        "tags": every("tags"),
        "source_url": F.col("url"),
    }


def _quote_columns() -> dict[str, Column]:
    reason = (
        F.when(_blank("title_raw"), V.REASON_NO_QUOTE)
        .when(_blank("author_raw"), V.REASON_NO_AUTHOR)
        .when(~_web_url(F.col("source_url")), "invalid source_url")
    )
    return {
        "reason": reason,
        "payload": F.create_map(F.lit("quote_html"), F.col("fragment")),
        "price": _absent(PRICE_TYPE),
        "attributes": F.to_json(F.struct("author", "tags"), {"ignoreNullFields": "false"}),
        "completeness_score": F.lit(1.0),
        "record_id": record_id(F.col("site_id"), F.col("source_url"), F.col("title")),
        "content_hash": content_hash(F.col("title"), F.col("author")),
    }


def _article_fields() -> dict[str, Column]:
    return {
        "title_raw": first("heading_raw"),
        "title": first("heading"),
        "short_description": first("short_description"),
        "summary": lead_paragraph(every("paragraphs")),
        "source_url": F.col("url"),
    }


def _article_columns() -> dict[str, Column]:
    reason = F.when(F.col("summary").isNull(), V.REASON_NO_LEAD).when(
        ~_web_url(F.col("source_url")), "invalid source_url"
    )
    return {
        "reason": reason,
        "payload": F.create_map(F.lit("title"), F.col("title_raw")),
        "price": _absent(PRICE_TYPE),
        "attributes": F.to_json(
            F.struct("short_description", "summary"), {"ignoreNullFields": "false"}
        ),
        "completeness_score": F.when(_blank("short_description"), 0.5).otherwise(1.0),
        "record_id": record_id(F.col("site_id"), F.col("source_url")),
        "content_hash": content_hash(F.col("title"), F.col("summary")),
    }


EXTRACTORS = {
    "product_listing": Extractor(
        PRODUCT_LISTING, V.ERROR_NO_PRODUCTS, "http", _product_fields, _product_columns
    ),
    "quote": Extractor(QUOTE, V.ERROR_NO_QUOTES, "browser", _quote_fields, _quote_columns),
    "article": Extractor(ARTICLE, V.ERROR_NO_HEADING, "http", _article_fields, _article_columns),
}

# Field columns every kind has in common; a kind without one leaves it null.
COMMON_FIELDS = ("title", "source_url", "price_digits", "currency", "availability")

PAGE_KEY = ("site_id", "run_id", "page_ord", "url", "fetched_at")


def extract(pages: DataFrame, extractors: Mapping[str, Extractor] | None = None) -> DataFrame:
    """Parse raw pages into one row per container, each a record, a reject or a page error.

    `kind` tells which: `record`, `reject` (with `reason` and `payload`) or `page_error` (with
    `reason`). Each page goes through the extractor that its `module` column names. All page kinds
    share one scan and one Python stage; the column rules of the kinds are chosen row by row.
    """
    extractors = extractors or EXTRACTORS
    # Pages that were not fetched never reach the Python stage.
    ok = F.coalesce(F.col("status_code") == 200, F.lit(False))
    specs = {name: one.spec for name, one in extractors.items()}
    found = harvest(pages.filter(ok), specs, keep=(*PAGE_KEY, "module"))

    def page_error(one: Extractor) -> Column:
        if one.spec.container:
            empty = F.col("element_ord").isNull()
        else:
            empty = F.coalesce(first(one.spec.rules[0].name), F.lit("")) == ""
        return F.when(empty, F.concat(F.lit(one.no_container), F.col("url")))

    fields = _by_kind(
        {
            name: dict.fromkeys(COMMON_FIELDS, _absent("string"))
            | one.fields()
            | {"page_error": page_error(one), "fetch_strategy": F.lit(one.fetch_strategy)}
            for name, one in extractors.items()
        }
    )
    cleaned = found.select(*PAGE_KEY, "module", "element_ord", "fragment", *fields)
    columns = _by_kind({name: one.derive() for name, one in extractors.items()})
    derived = cleaned.select(
        *PAGE_KEY, "element_ord", *COMMON_FIELDS, "page_error", "fetch_strategy", *columns
    )
    kind = F.when(F.col("page_error").isNotNull(), "page_error").when(
        F.col("reason").isNotNull(), "reject"
    )
    parsed = derived.withColumns(
        {
            "kind": kind.otherwise("record"),
            "reason": F.coalesce("page_error", "reason"),
            # only a reject needs its source kept
            "payload": F.when(kind == "reject", F.col("payload")),
        }
    )
    status = F.coalesce(F.col("status_code").cast("string"), F.lit("None"))
    errors = pages.filter(~ok).select(
        *PAGE_KEY,
        F.lit("page_error").alias("kind"),
        F.concat(F.lit(V.ERROR_STATUS), status, F.lit(" fetching "), F.col("url")).alias("reason"),
    )
    return parsed.drop("page_error").unionByName(errors, allowMissingColumns=True)


def _by_kind(columns: dict[str, dict[str, Column]]) -> list[Column]:
    """Columns of several page kinds as one list, each chosen by `module` where kinds share it."""
    out: dict[str, Column] = {}
    for kind, by_name in columns.items():
        is_kind = F.col("module") == kind
        for name, value in by_name.items():
            out[name] = out[name].when(is_kind, value) if name in out else F.when(is_kind, value)
    return [column.alias(name) for name, column in out.items()]


def extract_sites(
    pages: DataFrame, registry: DataFrame, extractors: Mapping[str, Extractor] | None = None
) -> DataFrame:
    """`extract` with the page kind taken from the site's registry row.

    Sites that are unknown or disabled yield nothing (see `resolve_sites`).
    """
    sites = registry.filter("enabled").select(F.col("id").alias("site_id"), "module")
    return extract(pages.join(sites, "site_id"), extractors)


def records_of(extracted: DataFrame, runs: DataFrame) -> DataFrame:
    """The records, stamped with their run's lineage. Keeps the order columns and price digits."""
    lineage = runs.select("site_id", "run_id", "started_at", "scraper_version", "backend")
    stamped = (
        extracted.filter(F.col("kind") == "record")
        .join(lineage, ["site_id", "run_id"])
        .withColumn("scraped_at", F.col("fetched_at"))
        .withColumn("extraction_method", F.lit("css"))
    )
    return stamped.select(*RECORD_COLUMNS, "price_digits", "started_at", "page_ord", "element_ord")


def rejects_of(extracted: DataFrame) -> DataFrame:
    """The quarantine rows: rejected containers with reason and payload."""
    return extracted.filter(F.col("kind") == "reject").select(
        "site_id",
        F.col("url").alias("source_url"),
        "run_id",
        F.col("fetched_at").alias("quarantined_at"),
        "reason",
        "payload",
    )


class PageError(RuntimeError):
    """Raised in fail-fast mode for a page that cannot be parsed."""


def page_errors_of(extracted: DataFrame, *, fail_fast: bool = False) -> DataFrame:
    """Pages without a usable response or container; `fail_fast` raises on the first one."""
    errors = extracted.filter(F.col("kind") == "page_error").select(*PAGE_KEY, "reason")
    if fail_fast:
        for row in errors.select("reason").head(1):
            raise PageError(row.reason)
    return errors


def extractor_health(extracted: DataFrame, *, min_share: float = 1.0) -> DataFrame:
    """Share of pages per site and day in which the selectors matched.

    One row per (page) first, so that a page with many containers weighs as one.
    """
    by_page = extracted.groupBy(
        "site_id", F.to_date("fetched_at").alias("dt"), "run_id", "page_ord", "url"
    ).agg(F.max((F.col("kind") != "page_error").cast("int")).alias("matched"))
    share = F.avg("matched")
    return (
        by_page.groupBy("site_id", "dt")
        .agg(F.count("*").alias("pages"), F.sum("matched").alias("matched"), share.alias("share"))
        .withColumn("healthy", F.col("share") >= min_share)
        .withColumn(
            "message", F.format_string("%d of %d pages matched", F.col("matched"), F.col("pages"))
        )
    )
