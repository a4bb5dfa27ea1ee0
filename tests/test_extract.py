"""Extraction on inline HTML."""

import datetime
import json
import sys
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gristmill import schemas
from gristmill.operators import extract as X
from gristmill.operators.markup import Harvester, Rule, Spec
from gristmill.sources.registry import default_registry

T0 = datetime.datetime(2026, 1, 1)

GOOD = """<article class="product_pod"><div class="image_container"><a href="x"><img src="../m/a.jpg">
</a></div><p class="star-rating Three"></p><h3><a href="a/index.html" title="A &amp; B">A ...</a></h3>
<p class="price_color">£51.77</p><p class="instock availability"><i></i>
   In stock
</p></article>"""


def pages(spark, *rows):
    full = [
        (site, "r1", i, f"https://x.example/c/page-{i}.html", status, {}, body.encode(), T0, "text/html")
        for i, (site, status, body) in enumerate(rows)
    ]
    return spark.createDataFrame(full, schemas.RAW_PAGES)


def parse(spark, *rows):
    extracted = X.extract_sites(pages(spark, *rows), default_registry(spark))
    return extracted.orderBy("page_ord", "element_ord").collect()


def test_product_listing(spark):
    (row,) = parse(spark, ("books_sandbox", 200, GOOD))
    assert row.kind == "record"
    assert (row.title, row.price, row.currency) == ("A & B", Decimal("51.77"), "GBP")
    assert row.availability == "In stock" and row.completeness_score == 1.0
    assert row.source_url == "https://x.example/c/a/index.html"
    assert json.loads(row.attributes) == {"rating": 3, "image_url": "https://x.example/m/a.jpg"}
    assert row.fetch_strategy == "http" and row.payload is None


@pytest.mark.parametrize(
    "old, new, reason",
    [
        (' title="A &amp; B"', "", "missing title anchor in product listing"),
        (' href="a/index.html"', "", "missing detail link in product listing"),
        ('<p class="price_color">£51.77</p>', "", "missing price in product listing"),
        ("£51.77", "£N/A", "cannot parse price from '£N/A'"),
        ("£51.77", "51.77", "no recognized currency symbol in '51.77'"),
        ("£51.77", "N/A", "cannot parse price from 'N/A'"),  # price comes before currency
        ('href="a/index.html"', 'href="ftp://x/a"', "invalid source_url"),
    ],
)
def test_first_failing_check_is_the_reason(spark, old, new, reason):
    bad = GOOD.replace(old, new)
    rejected, kept = parse(spark, ("books_sandbox", 200, bad + GOOD))
    assert rejected.kind == "reject" and rejected.reason == reason
    assert rejected.payload["article_html"].startswith('<article class="product_pod">')
    assert rejected.payload["article_html"].endswith("</article>")
    assert kept.kind == "record"


def test_missing_availability_lowers_completeness(spark):
    body = GOOD.replace("instock", "outofstock")
    (row,) = parse(spark, ("books_sandbox", 200, body))
    assert row.kind == "record" and row.availability is None and row.completeness_score == 0.75


def test_quotes(spark):
    body = """<div class=quote><span class=text>“To be”</span><small class='author'> Ann </small>
    <div class=tags><a class=tag>life</a><a class="tag x">t2</a></div></div>
    <div class="quote"><span class="text"> </span><small class="author">B</small></div>
    <div class="quote"><span class="text">x</span><small class="author"></small></div>"""
    good, no_text, no_author = parse(spark, ("quotes_js", 200, body))
    assert json.loads(good.attributes) == {"author": "Ann", "tags": ["life", "t2"]}
    assert good.title == "“To be”" and good.price is None and good.completeness_score == 1.0
    assert (no_text.reason, no_author.reason) == ("missing quote text", "missing author")


def test_same_quote_on_two_sites_hashes_alike(spark):
    body = '<div class="quote"><span class="text">q</span><small class="author">a</small></div>'
    first, second = parse(spark, ("quotes_js", 200, body), ("quotes_scroll", 200, body))
    assert first.content_hash == second.content_hash and first.record_id != second.record_id


LONG = "Git is a distributed version control system [38] that tracks versions of files , often used"


def test_article(spark):
    body = f"""<h1 id="firstHeading"><span>Git</span></h1><div class="shortdescription">VCS</div>
    <p>{LONG} outside the content</p>
    <div id="mw-content-text"><p></p><p>short</p><p><b>Git</b> {LONG}</p></div>"""
    (row,) = parse(spark, ("wikipedia_tech", 200, body))
    attributes = json.loads(row.attributes)
    assert row.title == "Git" and row.completeness_score == 1.0
    assert attributes["short_description"] == "VCS"
    assert attributes["summary"].startswith("Git Git is") and "files, often" in attributes["summary"]
    assert "[38]" not in attributes["summary"]
    (half,) = parse(spark, ("wikipedia_tech", 200, body.replace("shortdescription", "other")))
    assert half.completeness_score == 0.5


def test_article_without_lead_is_rejected(spark):
    body = '<h1 id="firstHeading">Stub</h1><div id="mw-content-text"><p>short</p></div>'
    (row,) = parse(spark, ("wikipedia_tech", 200, body))
    assert row.kind == "reject" and row.reason == "no substantial lead paragraph found"
    assert row.payload == {"title": "Stub"}


def test_page_errors(spark):
    rows = parse(
        spark,
        ("books_sandbox", 503, GOOD),
        ("books_sandbox", 200, "<html></html>"),
        ("quotes_js", 200, ""),
        ("wikipedia_tech", 200, '<h1 id="firstHeading"> </h1>'),
        ("unknown_site", 200, GOOD),
    )
    assert [row.kind for row in rows] == ["page_error"] * 4
    assert [row.reason.rsplit(" ", 1)[0] for row in rows] == [
        "unexpected status 503 fetching",
        "no product listings found on",
        "no rendered quotes found on",
        "no article heading found on",
    ]


def test_fail_fast_raises_on_a_page_error(spark):
    extracted = X.extract_sites(pages(spark, ("books_sandbox", 503, "")), default_registry(spark))
    assert X.page_errors_of(extracted).count() == 1
    with pytest.raises(X.PageError, match="unexpected status 503"):
        X.page_errors_of(extracted, fail_fast=True)


def test_lineage_and_rejects(spark):
    extracted = X.extract_sites(
        pages(spark, ("books_sandbox", 200, GOOD + GOOD.replace("£51.77", ""))), default_registry(spark)
    )
    runs = spark.createDataFrame([("r1", "books_sandbox", T0, "abc", "local")], schemas.RUNS)
    record = X.records_of(extracted, runs).first()
    assert (record.run_id, record.scraper_version, record.backend) == ("r1", "abc", "local")
    assert record.scraped_at == T0 and record.extraction_method == "css"
    reject = X.rejects_of(extracted).first()
    assert reject.source_url == "https://x.example/c/page-0.html"
    assert reject.reason == "cannot parse price from ''"


def test_health_counts_pages_not_containers(spark):
    drifted = GOOD.replace("product_pod", "other")
    extracted = X.extract_sites(
        pages(spark, ("books_sandbox", 200, GOOD * 5), ("books_sandbox", 200, drifted)),
        default_registry(spark),
    )
    row = X.extractor_health(extracted).first()
    assert (row.pages, row.matched, row.share, row.healthy) == (2, 1, 0.5, False)


def test_own_extractor_plugs_in(spark):
    spec = Spec("news", "div.story", (Rule("headline", "h2", form="nfkc"),))
    mine = X.Extractor(
        spec,
        "no stories on ",
        "http",
        lambda: {"title": X.first("headline"), "source_url": F.col("url")},
        lambda: {
            "reason": F.when(F.col("title").isNull(), "no headline"),
            "payload": F.create_map(F.lit("url"), F.col("url")),
        },
    )
    body = "<div class=story><h2>One</h2></div><div class=story></div>"
    routed = pages(spark, ("n", 200, body)).withColumn("module", F.lit("news"))
    rows = X.extract(routed, {"news": mine}).orderBy("element_ord").collect()
    assert [(r.kind, r.title) for r in rows] == [("record", "One"), ("reject", None)]


def test_table_function(spark):
    X.register_harvest(spark)
    pages(spark, ("books_sandbox", 200, GOOD * 2)).createOrReplaceTempView("fetched")
    rows = spark.sql(
        "SELECT h.element_ord, h.found['price'][0] AS price FROM fetched p, "
        "LATERAL harvest(p.body, p.url, 'product_listing') h ORDER BY 1"
    ).collect()
    assert [tuple(r) for r in rows] == [(0, "£51.77"), (1, "£51.77")]


# ---- the row-level helper --------------------------------------------------------------------


def harvest(html, *rules, container=""):
    boxes = Harvester(Spec("t", container, rules)).harvest(html, "https://x.example/a/")
    return [values for values, _ in boxes]


def test_unclosed_and_implied_tags():
    html = "<article><p>one<b>bold<p>two</b> more<ul><li>x<li>y</ul></article><p>out"
    (found,) = harvest(html, Rule("p", "article p", "joined", many=True), Rule("li", "li", many=True))
    assert found["p"] == ["one bold", "two more"] and found["li"] == ["x", "y"]


def test_markup_inside_scripts_comments_and_quotes_is_text():
    html = "<script>var t='<p>no</p>';</script><!-- <p>no</p> --><p title='a>b'>yes &lt;p&gt;</p>"
    (found,) = harvest(html, Rule("p", "p", many=True), Rule("t", "p", "@title"))
    assert found == {"p": ["yes <p>"], "t": ["a>b"]}


def test_text_nodes_are_stripped_and_joined_without_a_separator():
    (found,) = harvest("<div> a <i> b </i> c </div>", Rule("d", "div"), Rule("j", "div", "joined"))
    assert found == {"d": ["abc"], "j": ["a b c"]}


@pytest.mark.parametrize("piece", ["<a", "<!--", "<a 'x", "<!x", "<script>", "<p><a b=\""])
def test_unclosed_markup_stays_linear(piece):
    (found,) = harvest("<p>seen</p>" + piece * 100_000, Rule("p", "p"))
    assert found["p"] == ["seen"]


def test_child_step_and_container_scope():
    html = "<h3><b><a title=no></a></b><a title=yes></a></h3><div class=c><h3><a title=in></a></h3></div>"
    (found,) = harvest(html, Rule("t", "h3 > a", "@title"))
    assert found["t"] == ["yes"]
    (inside,) = harvest(html, Rule("t", "h3 > a", "@title"), container="div.c")
    assert inside["t"] == ["in"]


def test_bad_encoding_does_not_fail_the_job(spark):
    body = "<div class=quote><span class=text>caf\xe9</span><small class=author>a</small></div>"
    row = ("quotes_js", "r1", 0, "https://x.example/", 200, {}, body.encode("latin-1"), T0, None)
    raw = spark.createDataFrame([row], schemas.RAW_PAGES)
    (parsed,) = X.extract_sites(raw, default_registry(spark)).collect()
    assert parsed.kind == "record" and parsed.title == "caf�"


@pytest.mark.parametrize("title, price, url, record, content", [
    (
        "A Light in the Attic", "51.77",
        "https://books.toscrape.com/catalogue/a-light-in-the-attic_1000/index.html",
        None, "23ebaf6fcaa6bc667248a0ab680ed82c6c85a34dfc2b90ffa2a3cdc65fb472ff",
    ),
])
def test_golden_hash(spark, title, price, url, record, content):
    body = GOOD.replace("A &amp; B", title).replace("51.77", price)
    (row,) = parse(spark, ("books_sandbox", 200, body))
    assert row.content_hash == content


def test_many_pages_of_one_batch_go_out_in_parts(spark, monkeypatch):
    """Neither the rows found nor the bodies they came from pile up in a task's Python."""

    class Caught:
        def mapInArrow(self, run, schema):
            return run

    n = 400
    monkeypatch.setattr(X, "spread", lambda source: Caught())
    run = X.harvest(pages(spark, *[("s", 200, GOOD)]), X.PRODUCT_LISTING, keep=("page_ord",))
    filler = "x" * 2000
    batch = pa.RecordBatch.from_pydict({
        "page_ord": pa.array(range(n), pa.int32()),
        "_url": [f"https://x.example/c/{k}.html" for k in range(n)],
        "_body": [f"<p>{filler}</p>".encode() + (GOOD * (k % 20)).encode() for k in range(n)],
        "_spec": [X.PRODUCT_LISTING.name] * n,
    })
    parts, most, before = [], 0, pa.total_allocated_bytes()
    for part in run(iter([batch])):
        parts.append((part.num_rows, list(zip(*(part.column(c).to_pylist() for c in ("page_ord", "element_ord"))))))
        most = max(most, part.num_rows)
        del part
    assert most < X.PART_ROWS + 20
    want = [(k, e) for k in range(n) for e in (range(k % 20) if k % 20 else [None])]
    assert [row for _, rows in parts for row in rows] == want
    assert pa.total_allocated_bytes() - before < 4 << 20


def test_arrow_batches_of_large_pages_stay_small(spark, monkeypatch):
    class Held:
        """Gives the size of the Arrow batch that the page came in."""

        def __init__(self, spec):
            pass

        def harvest(self, html, page_url):
            return [({"held": [str(sys._getframe(1).f_locals["batch"].nbytes)]}, "")]

    monkeypatch.setattr(X, "Harvester", Held)
    for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{key}")
    large = spark.range(0, 80, 1, 1).select(
        F.col("id"), F.lit("https://x.example/").alias("url"), F.repeat(F.lit("x"), 1 << 20).alias("body")
    )
    monkeypatch.setattr(X, "spread", lambda df: df)
    found = X.harvest(large, Spec("page", "", (Rule("held", "p"),)), keep=("id",))
    rows = found.select("id", X.first("held").cast("long").alias("held")).collect()
    assert sorted(r.id for r in rows) == list(range(80))
    assert max(r.held for r in rows) < 16 << 20
