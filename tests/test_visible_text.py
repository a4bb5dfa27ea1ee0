"""Visible text: what a parser takes for the body, in one pass however long a tag is."""

import time

import pytest
from gristmill.operators import classify
from pyspark.sql import functions as F

LONG = "x" * 60

CASES = [
    ("<html><head><title>T</title></head><body><p> a </p>b</body></html>", "ab"),
    # without a body tag
    ("<html></html>", ""),
    ("", ""),
    (None, ""),
    ("<title>T</title><p>a", "a"),
    ("<!DOCTYPE html><meta charset=x>\n<title>T</title> hello <b>w</b>", "hellow"),
    ("<html><head><link rel=x><style>p{}</style></head>text</html>", "text"),
    ("just text", "just text"),
    ("<head>early<title>T</title></head><body>b", "earlyTb"),
    # text before and behind the body's tags is in the body
    ("lead<body>a</body> tail</html> end", "leadatailend"),
    # a body tag in a comment, a script or an attribute is none
    ("<!-- <body> --><title>T</title><div>a</div>", "a"),
    ("<script>'<body>'</script><title>T</title><i>a</i>", "a"),
    ('<meta content="<body>"><title>T</title><i>a</i>', "a"),
    # quotes
    ('<body class="a>b" id=c>x', "x"),
    ("<body><p title=it's>don't</p> <p title='>'>c</p>", "don'tc"),
    ('<body><a href="never closed>gone', ""),
    ("<body><a href = '>' >x</a>", "x"),
    ("<body>a<b", "a"),
    ("<body>1 < 2 <3", "1 < 2 <3"),
    # script and style hold no text, whatever stands in them
    ("<body>a<script>if (a</b>) '</p>' <!-- </SCRIPT >b<style>x</style>c<script>open", "abc"),
    ("<body><scripted>a</scripted>", "a"),
    # a title in the body is text
    ("<body><svg><title>logo</title></svg>a", "logoa"),
    ("<body>&lt;p&gt;&nbsp;x &quot;y&quot; \0z", '<p>\xa0x "y" z'),
]


@pytest.fixture(scope="module")
def texts(spark):
    df = spark.createDataFrame([(k, html) for k, (html, _) in enumerate(CASES)], "k int, html string")
    found = df.select("k", classify.visible_text(F.col("html")).alias("text")).collect()
    return {r.k: r.text for r in found}


@pytest.mark.parametrize("k", range(len(CASES)))
def test_cases(texts, k):
    assert texts[k] == CASES[k][1]


@pytest.mark.parametrize(
    "html",
    [
        "<body><p" + ' a="b>c"' * 1_000_000 + ">x",
        "<body><p" + " a='" * 1_000_000,
        '<body>x<a "' * 200_000,
        "<body>" + "<p a=\"'>" * 200_000 + "x",
        "<body>" + "<" * 1_000_000,
        "<body>" + "<!--" * 300_000,
        "<body>" + "<script>" * 200_000,
        "<title>" * 200_000,
        "<body>" + "</p" * 300_000,
        "<body " + "=" * 1_000_000 + ">x",
    ],
    ids=range(10),
)
def test_long_markup_takes_one_pass(spark, html):
    start = time.perf_counter()
    df = spark.createDataFrame([(html,)], "html string")
    df.select(F.length(classify.visible_text(F.col("html")))).collect()
    assert time.perf_counter() - start < 20
