"""Scalar functions, and the traps around Unicode, prices, hashes and dates."""

import datetime
import re
import unicodedata
from decimal import Decimal
from urllib.parse import quote, unquote, urljoin

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gristmill import functions as M
from gristmill.functions.dates import java_pattern
from gristmill.functions.urls import percent_decode, percent_encode


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = rows.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()
    return [row.o for row in out]


PRICES = {
    "£51.77": "51.77",
    "1,234.50": "1234.50",
    "-5": "5",
    "1.234,50": "1.23450",
    "": None,
    ".": None,
    "1.2.3": None,
    "free": None,
    "10.00": "10.00",
    "007.50": "7.50",
    ".5": "0.5",
    "5.": "5",
    "£ 0": "0",
    "٣٫٥٠": "350",
    "５.５": "5.5",
    "5²": None,
}


def test_price_digits_match_decimal_text(spark):
    got = column(spark, list(PRICES), M.price_digits)
    assert dict(zip(PRICES, got)) == PRICES
    for raw, digits in PRICES.items():
        kept = "".join(ch for ch in raw.strip() if ch.isdigit() or ch == ".")
        if digits is not None:
            assert str(Decimal(kept)) == digits


def test_price_as_decimal_keeps_five_places(spark):
    assert column(spark, ["1.234,50", "x"], M.decimal_price) == [Decimal("1.2345000000"), None]


def test_currency_only_by_leading_symbol(spark):
    raw = ["£5", " $5", "€", "5 £", "", "GBP 5"]
    assert column(spark, raw, M.currency_code) == ["GBP", "USD", "EUR", None, None, None]


def test_strip_takes_all_unicode_whitespace(spark):
    raw = ["  a b　\x1c\x1f\n", "", "   ", "a"]
    assert column(spark, raw, M.strip) == [text.strip() for text in raw]


def test_nfkc_strip(spark):
    raw = ["ﬁ １２ ", " Å", "é"]
    expected = [unicodedata.normalize("NFKC", t).strip() for t in raw]
    assert column(spark, raw, M.nfkc_strip) == expected


def test_nfkc_strip_holds_few_texts_as_strings():
    import tracemalloc

    function = M.nfkc_strip.func
    text = "ﬁ " + "x\u4e00" * 2000
    whole = pa.array([text, None] * 2000)
    tracemalloc.start()
    got = function(whole)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.to_pylist()[-2:] == [unicodedata.normalize("NFKC", text), None] and len(got) == 4000
    assert most < 4 << 20


def test_article_clean_up(spark):
    raw = [
        "Rust [ 38 ] is , a language [é1]\n\t.  End ;",
        "[not a marker] stays [a b]",
        "a  b\x0b:c , ,",
    ]
    expected = ["Rust is, a language. End;", "[not a marker] stays [a b]", "a b:c,,"]
    assert column(spark, raw, M.clean_article_text) == expected


def test_resolve_url(spark):
    base = "https://shop.example/catalogue/page-1.html"
    hrefs = ["item/index.html", "../media/a.jpg", "https://other.example/x", " /root ", "?q=1"]
    got = column(spark, hrefs, lambda c: M.resolve_url(c, F.lit(base)))
    assert got == [urljoin(base, h.strip()) for h in hrefs]


def test_percent_encoding_round_trip(spark):
    titles = ["Go_(lang)", "C++ & é~*", "a/b c%zz", "100%"]
    assert column(spark, titles, percent_encode) == [quote(t) for t in titles]
    urls = ["a%20b+c%2F", "%zz%41", "é%C3%A9"]
    assert column(spark, urls, percent_decode) == [unquote(u) for u in urls]


def test_url_keys(spark):
    urls = ["https://A.example:80/x?y", "HTTP://b.example", "nothing"]
    assert column(spark, urls, M.authority) == ["A.example:80", "b.example", ""]
    assert column(spark, urls, M.origin)[:2] == ["https://A.example:80", "http://b.example"]


def test_stored_url(spark):
    urls = {
        "HTTPS://Shop.Example:443": "https://shop.example/",
        "http://a.example:8080?q=A": "http://a.example:8080/?q=A",
        "http://a.example:80/X?y#Z": "http://a.example/X?y#Z",
        "https://a.example/x/": "https://a.example/x/",
        "nothing": "nothing",
    }
    assert column(spark, list(urls), M.stored_url) == list(urls.values())


def test_hashes_spell_absent_parts(spark):
    row = spark.range(1).select(
        M.content_hash(F.lit("A Light in the Attic"), F.lit("51.77"), F.lit("In stock")).alias("a"),
        M.content_hash(F.lit("a"), F.lit(None).cast("string")).alias("b"),
        M.content_hash(F.lit("a"), F.lit("None")).alias("c"),
    ).first()
    assert row.a == "23ebaf6fcaa6bc667248a0ab680ed82c6c85a34dfc2b90ffa2a3cdc65fb472ff"
    assert row.b == row.c


@pytest.mark.parametrize(
    "fmt, raw",
    [
        ("%Y-%m-%d", " 2026-03-09 "),
        ("%Y%m%d%H%M%S", "20260309070809"),
        ("%d %b %Y %H:%M", "9 Mar 2026 07:08"),
        ("%d/%m/%Y", "9/3/2026"),
        ("%Y-%m-%dT%H:%M:%S%z", "2026-03-09T07:08:09+02:00"),
    ],
)
def test_datetime_like_strptime(spark, fmt, raw):
    expected = datetime.datetime.strptime(raw.strip(), fmt)
    if expected.tzinfo:
        expected = expected.astimezone(datetime.UTC).replace(tzinfo=None)
    got, bad = column(spark, [raw, "soon"], lambda c: M.parse_datetime(c, fmt).cast("timestamp_ntz"))
    assert got == expected and bad is None


def test_weekday_formats_are_refused():
    with pytest.raises(ValueError):
        java_pattern("%A %d")


def test_reason_quoting_follows_repr(spark):
    raw = ["£x", "it's", 'a"b', "both ' and \"", "line\n", "back\\slash"]
    assert column(spark, raw, M.quoted) == [repr(t) for t in raw]


def test_run_id(spark):
    row = spark.sql("select timestamp'2026-01-02 03:04:05' t, 'ab12cd34-ef' k").select(
        M.run_id_from(F.col("t"), F.col("k")).alias("r")
    )
    assert row.first().r == "20260102T030405Z-ab12cd34"


def test_malformed_link_is_null(spark):
    from gristmill.functions.urls import resolve_url

    df = spark.createDataFrame([("http://[x", "http://a/"), ("b", "http://a/")], "h string, b string")
    assert [r[0] for r in df.select(resolve_url("h", "b")).collect()] == [None, "http://a/b"]


def test_empty_page_range_has_no_targets(spark):
    from gristmill.operators.frontier import PAGED, paged_targets

    rows = [("s", "http://a/{page}", 1, 0, None), ("t", "http://a/{page}", 1, 2, None)]
    assert paged_targets(spark.createDataFrame(rows, PAGED)).count() == 2


def test_citation_markers_are_letters_numbers_and_underscores(spark):
    texts = ["a[1]b", "a[ x_2 ]b", "a[\x1c½²]b", "a[é]b", "a[‿]b", "a[]b", "a[1 2]b", "a[注釈]b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.c for r in df.orderBy("i").select(M.clean_article_text(F.col("t")).alias("c")).collect()]
    want = [re.sub(r"\[\s*\w+\s*\]", "", t) for t in texts]
    assert got == want
