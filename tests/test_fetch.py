"""Fetch log, breaker, pacing, robots and classification."""

import datetime
import random
from urllib.robotparser import RobotFileParser

import pytest
from pyspark.sql import functions as F

from gristmill import fixed_values as V
from gristmill import schemas
from gristmill.operators import breaker, classify, fetchlog, frontier, pacing, robots

T0 = datetime.datetime(2026, 1, 1)
S = datetime.timedelta(seconds=1)


def log(spark, rows):
    full = [
        ("s", "d", url, no, no, T0 + no * S, status, kind, headers or {}, 1.0)
        for url, no, status, kind, headers in rows
    ]
    return spark.createDataFrame(full, schemas.FETCH_LOG)


def test_error_classes(spark):
    rows = [("u", i, s, k, None) for i, (s, k) in enumerate(
        [(200, None), (429, None), (500, None), (599, None), (600, None), (404, None),
         (None, "fetch_error"), (None, "robots_disallowed")])]
    classes = [r.error_class for r in fetchlog.attempts(log(spark, rows)).orderBy("seq").collect()]
    assert classes == [
        "not_retryable", "rate_limited", "server_error", "server_error", "not_retryable",
        "not_retryable", "timeout_or_network", "not_retryable",
    ]


@pytest.mark.parametrize(
    "value, seconds",
    [
        ("30", 30.0), (" 7 ", 7.0), ("999", 60.0), ("soon", None), ("-5", None), ("", None),
        ("Thu, 01 Jan 2026 00:00:31 GMT", 30.0),
        ("Thu, 01 Jan 2026 00:00:31 +0000", 30.0),
        ("Thursday, 01-Jan-26 00:00:31 GMT", 30.0),
        ("1 Jan 2026 00:00:31", 30.0),
        ("Wed, 31 Dec 2025 00:00:00 GMT", 0.0),
        ("Thu Jan  1 00:00:31 2026", 30.0), ("Thu, 01 Jan 2026 00:01 GMT", 59.0),
        ("Thu, 01 Jan 2026 00:00:31 UT", 30.0), ("Wed, 31 Dec 2025 19:00:31 EST", 30.0),
        ("Thu, 01 Jan 2026 01:30:31 +0130", 30.0), ("Thu, 01 Jan 2026 00:00:31 XYZ", 30.0),
        ("Thursday, 01-Jan-94 00:00:31 GMT", 0.0), ("32 Jan 2026 00:00:31", None),
        ("1 Foo 2026 00:00:31", None), ("1 Jan 2026 24:00:31", None), ("1 Jan 2026 00:00:60", None),
        ("Fri, 02 Jan 2026 00:00:00 GMT", 60.0),
    ],
)
def test_retry_after(spark, value, seconds):
    rows = [("u", 1, 429, None, {"RETRY-after": value, "x": "1"}), ("v", 2, 429, None, {"x": "5"})]
    out = fetchlog.attempts(log(spark, rows)).orderBy("seq").collect()
    assert out[0].retry_after == seconds and out[1].retry_after is None


def test_outcomes_tell_runs_apart(spark):
    rows = [("u", 1, 503, None, None), ("u", 1, 200, None, None)]
    two = log(spark, rows).withColumn("run_id", F.col("status_code").cast("string"))
    out = fetchlog.outcomes(fetchlog.attempts(two))
    assert sorted((r.status_code, r.logged_attempts) for r in out.collect()) == [(200, 1), (503, 1)]
    assert fetchlog.outcomes(fetchlog.attempts(two.drop("run_id"))).count() == 1


def test_wait_bounds(spark):
    rows = [("u", n, None, "fetch_error", None) for n in (1, 3, 5)]
    rows += [("v", n, 503, None, None) for n in (1, 6)] + [("w", n, 429, None, None) for n in (2, 9)]
    out = fetchlog.attempts(log(spark, rows)).orderBy("url", "seq").collect()
    bounds = [(round(r.wait_min, 6), round(r.wait_max, 6)) for r in out]
    assert bounds == [(0.2, 0.3), (0.8, 1.2), (2.0, 3.0), (1.0, 1.25), (30.0, 37.5), (2.0, 2.0), (60.0, 60.0)]


def outcome(spark, *statuses):
    rows = [("u", i + 1, None if s == "net" else s, "fetch_error" if s == "net" else None, None)
            for i, s in enumerate(statuses)]
    return fetchlog.outcomes(fetchlog.attempts(log(spark, rows))).first()


def test_budget_is_that_of_the_current_error(spark):
    assert outcome(spark, "net", "net", 503, 200).attempt_no == 3  # third 5xx attempt is the last
    assert outcome(spark, "net", "net", "net", 200).attempt_no == 4  # a timeout may go on
    row = outcome(spark, 429, 429)
    assert not row.finished and row.attempt_no == 2


def test_breaker_outcomes(spark):
    assert outcome(spark, 503, 503, 503).breaker_failure is True
    assert outcome(spark, 503, 404).breaker_failure is False
    disallowed = log(spark, [("u", 1, None, "robots_disallowed", None)])
    assert fetchlog.outcomes(fetchlog.attempts(disallowed)).first().breaker_failure is None


def machine(events, fail_max, reset):
    """The breaker, one outcome at a time."""
    state, count, opened = "closed", 0, None
    for ts, failed in events:
        if state == "open" and ts - opened >= reset:
            state = "half_open"
        before = state
        if failed:
            count += 1
            if state == "half_open" or count >= fail_max:
                state, opened = "open", ts
        else:
            state, count, opened = "closed", 0, None
        yield before, count, state == "open"


@pytest.mark.parametrize("chunk_seconds", [1, 60, 10**6])
def test_breaker_timeline_equals_the_machine(spark, chunk_seconds):
    rng = random.Random(3)
    rows, expected = [], {}
    for domain in "abc":
        at, events = 0, []
        for seq in range(200):
            at += rng.choice([0, 1, 5, 40, 70])
            failed = rng.random() < 0.75
            rows.append((domain, T0 + at * S, seq, failed))
            events.append((at, failed))
        for seq, result in enumerate(machine(events, 3, 60)):
            expected[domain, seq] = result
    results = spark.createDataFrame(rows, "domain string, ts timestamp, seq bigint, failed boolean")
    out = breaker.breaker_timeline(results, fail_max=3, chunk_seconds=chunk_seconds).collect()
    assert {(r.domain, r.seq): (r.state_before, r.streak, r.open_after) for r in out} == expected
    health = {r.domain: r for r in breaker.domain_health(results, fail_max=3).collect()}
    for domain in "abc":
        _, count, is_open = expected[domain, 199]
        assert health[domain].consecutive_failures == count and health[domain].breaker_open == is_open


def test_robots_outcomes_touch_no_breaker(spark):
    rows = [("d", T0 + i * S, i, f) for i, f in enumerate([True, None, True, None, True])]
    results = spark.createDataFrame(rows, "domain string, ts timestamp, seq bigint, failed boolean")
    out = breaker.breaker_timeline(results, fail_max=3).orderBy("seq").collect()
    assert [r.streak for r in out] == [1, 2, 3] and out[-1].open_after


def bucket(arrivals, rate, burst):
    """Admission times of a token bucket served in order."""
    tokens, updated, now = float(burst), arrivals[0], arrivals[0]
    for arrival in arrivals:
        now = max(now, arrival)
        tokens, updated = min(burst, tokens + (now - updated) * rate), now
        if tokens < 1 - 1e-12:
            now += (1 - tokens) / rate
            tokens, updated = 1.0, now
        tokens -= 1
        yield now


@pytest.mark.parametrize("chunk_seconds", [2, 30, 10**6])
def test_admissions_equal_a_token_bucket(spark, chunk_seconds):
    rng = random.Random(5)
    rows, expected = [], {}
    for domain, (rate, burst) in {"a": (0.5, 3), "b": (2.0, 1), "c": (1.0, 5)}.items():
        at, arrivals = 0.0, []
        for seq in range(150):
            at += rng.choice([0, 0.25, 0.5, 1, 9])
            arrivals.append(at)
            # only the first row's settings count
            shown = (rate, burst) if seq == 0 else (99.0, 99)
            rows.append((domain, T0 + at * S, seq, *shown))
        for seq, due in enumerate(bucket(arrivals, rate, burst)):
            expected[domain, seq] = round(due - arrivals[seq], 4)
    requests = spark.createDataFrame(
        rows, "domain string, ts timestamp, seq bigint, rps double, burst int"
    )
    out = pacing.audit_admissions(requests, chunk_seconds=chunk_seconds).collect()
    assert {(r.domain, r.seq): round(r.delay_seconds, 4) for r in out} == expected
    assert all(r.violates == (expected[r.domain, r.seq] > 0) for r in out)


def test_frontier_plan_counts_over_slices(spark):
    rows = [("d", i, 2.0 if i == 0 else 9.0, 3) for i in range(20)]
    targets = spark.createDataFrame(rows, "domain string, ordinal int, rps double, burst int")
    out = pacing.plan_frontier(targets, chunk_rows=6).orderBy("ordinal").collect()
    assert [r.position for r in out] == list(range(1, 21))
    assert [r.admit_after_seconds for r in out] == [max(0.0, (k - 3) / 2.0) for k in range(1, 21)]


def test_effective_rate(spark):
    rows = [(2.0, True, 5.0), (2.0, True, 0.1), (2.0, False, 5.0), (2.0, True, None), (2.0, True, 0.0)]
    table = spark.createDataFrame(rows, "rps double, respect boolean, delay double")
    rate = pacing.effective_rps(F.col("rps"), F.col("respect"), F.col("delay"))
    assert [r[0] for r in table.select(rate).collect()] == [0.2, 2.0, 2.0, 2.0, 2.0]


ROBOTS = """User-agent: badbot
Disallow: /

User-agent: mill
Allow: /private/ok
Disallow: /private
Disallow: /caf%C3%A9
Disallow: /q?x=1
Crawl-delay: 5

User-agent: *
Disallow: /all
"""


def test_robots_match_the_standard_parser(spark):
    paths = ["", "/", "/private/ok/1", "/private/x", "/café", "/caf%c3%a9/x", "/q?x=12", "/q?x=2",
             "/all/x", "/a?#", "/a?b#", "/Private", "/a%zz b", "/x;p?q#f"]
    origins = {"https://a.example": (200, ROBOTS), "https://b.example": (404, "x"),
               "https://c.example": (500, ROBOTS), "https://d.example": (None, None),
               "https://e.example": (200, ""), "https://f.example": (302, ROBOTS)}
    table = spark.createDataFrame([(o, s, b) for o, (s, b) in origins.items()], schemas.ROBOTS)
    urls = [o + p for o in [*origins, "https://unknown.example"] for p in paths]
    targets = spark.createDataFrame([(u,) for u in urls], "url string")
    out = robots.check_robots(targets, robots.robots_policies(table, "Mill/2.0 (+x)")).collect()
    got = {r.url: r for r in out}
    parser = RobotFileParser()
    parser.parse(ROBOTS.splitlines())
    for path in paths:
        url = "https://a.example" + path
        assert got[url].allowed == parser.can_fetch("Mill/2.0 (+x)", url), path
        assert got[url].crawl_delay == 5.0
        assert got["https://b.example" + path].allowed and got["https://e.example" + path].allowed
        for denied in ("c", "d", "f", "unknown"):
            assert not got[f"https://{denied}.example{path}"].allowed
    assert len(got) == len(set(urls))


TEXT = "A genuine description of a book. " * 4


@pytest.mark.parametrize(
    "body, expected",
    [
        (f"<html><body><h1>Title</h1><p>{TEXT}</p></body></html>", "ok"),
        ("<body><h1>Just a moment...</h1><p>Checking your browser</p></body>", "soft_block"),
        ("<body><h1>Please complete the CAPTCHA below</h1></body>", "soft_block"),
        ("<body><h1>ARE YOU A ROBOT?</h1></body>", "soft_block"),
        ('<html><body><div id="root"></div></body></html>', "empty_or_js_shell"),
        ('<body><div id="root">loading...</div><script>' + "x();" * 50 + "</script></body>",
         "empty_or_js_shell"),
        ("<html><body>   \n   </body></html>", "empty_or_js_shell"),
        ("<html></html>", "empty_or_js_shell"),
        (f"<html><head><title>captcha</title></head><body>{TEXT}</body></html>", "ok"),
        (f"<body><!-- captcha --><p title='a>b'>{TEXT}</p><style>captcha</style></body>", "ok"),
        ("<body>" + "<p> a </p>\n" * 49 + "</body>", "empty_or_js_shell"),
        ("<body>" + "<p> &amp; </p>\n" * 50 + "</body>", "ok"),
        (f"<body>{TEXT}<!-- captcha" + "<!--" * 20_000, "ok"),
        (f"<body>{TEXT}" + "<a" * 20_000, "ok"),
        (f"<body>{TEXT}<script>captcha" + "<script>" * 20_000, "ok"),
        ("<body>" + "<p>&nbsp;</p>" * 50 + "</body>", "empty_or_js_shell"),
    ],
)
def test_response_classes(spark, body, expected):
    rows = [(200, None, body.encode()), (503, None, body.encode()), (200, "application/json", body.encode()),
            (200, "Text/HTML; charset=x", body.encode())]
    pages = spark.createDataFrame(rows, "status_code int, content_type string, body binary")
    got = [r.response_class for r in classify.classify(pages).collect()]
    assert got == [expected, "ok", "ok", expected]


def test_escalation(spark):
    shell, full = b"<body></body>", f"<body>{TEXT}</body>".encode()
    blocked = b"<body>access denied</body>"
    rows = [("s", "r", url, 200, {}, body, T0, None) for url, body in
            [("a", full), ("b", shell), ("c", shell), ("d", blocked)]]
    schema = ("site_id string, run_id string, url string, status_code int, "
              "headers map<string,string>, body binary, fetched_at timestamp, content_type string")
    plain = classify.classify(spark.createDataFrame(rows, schema))
    rendered = spark.createDataFrame(
        [("s", "r", url, 200, {}, b"rendered", T0, None) for url in ("a", "b", "d")], schema
    )
    merged = classify.escalate(plain, rendered)
    out = {r.url: r for r in merged.collect()}
    assert {u: (r.fetched_by, r.needs_render) for u, r in out.items()} == {
        "a": ("http", False), "b": ("browser", False), "c": ("http", True), "d": ("http", False)}
    assert bytes(out["b"].body) == b"rendered" and bytes(out["a"].body) == full
    stats = classify.fetch_stats(merged).first()
    assert (stats.http_only_fetch_count, stats.escalated_fetch_count) == (2, 1)


def test_xhr_of_the_latest_fetch_only(spark):
    rows = [(1, "p", "old", "xhr", 200, None, b"x"), (2, "p", "a", "xhr", 200, None, b"1"),
            (2, "p", "b", "fetch", 200, None, b"2"), (2, "p", "c", "image", 200, None, b"3"),
            (2, "p", "d", "xhr", 200, None, None), (3, "q", "e", "image", 200, None, b"4")]
    captured = fetchlog.xhr_captures(spark.createDataFrame(rows, schemas.NETWORK_LOG))
    assert sorted(r.url for r in captured.collect()) == ["a", "b"]


def test_registered_frontier(spark):
    targets = frontier.registered_targets(spark).collect()
    by_site = {}
    for t in targets:
        by_site.setdefault(t.site_id, []).append(t)
    assert {s: len(ts) for s, ts in by_site.items()} == {
        "books_sandbox": 50, "quotes_js": 10, "quotes_scroll": 1, "wikipedia_tech": len(V.ARTICLE_TITLES)}
    assert by_site["quotes_scroll"][0].max_scroll_rounds == 15
    urls = {t.url for t in targets}
    assert "https://books.toscrape.com/catalogue/page-50.html" in urls
    assert "https://en.wikipedia.org/wiki/Go_%28programming_language%29" in urls


def test_latency_stats(spark):
    rows = [("s", "d", "u", 1, i, T0, 200 if i % 4 else 500, None, {}, float(i)) for i in range(100)]
    stats = fetchlog.latency_stats(spark.createDataFrame(rows, schemas.FETCH_LOG)).first()
    assert stats.success_rate == 0.75 and abs(stats.p95_latency_ms - 94) <= 1
