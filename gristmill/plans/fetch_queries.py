"""Fetch-log, breaker, pacing, robots and classification queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import authority
from gristmill.operators import breaker, classify, fetchlog, pacing, sketches
from gristmill.operators import robots as robots_rules
from gristmill.plans.adapters import (
    document_pages,
    fetch_log,
    fetch_results,
    naive,
    rendered_pages,
    robots,
    table,
)
from gristmill.plans.catalog import query
from gristmill.plans.zone_queries import fresh_root
from gristmill.sources import zones

LOG = """
log0 AS (
  SELECT event_id AS seq, ts, 'd' || user_id % 10 AS domain,
         'u' || user_id || '/' || strftime(ts, '%Y-%m-%d') AS url,
         row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS attempt_no,
         CASE event_type WHEN 'error' THEN 503 WHEN 'signup' THEN 429 WHEN 'click' THEN 404
                         WHEN 'view' THEN NULL ELSE 200 END AS status_code,
         CASE WHEN event_id % 50 = 0 THEN 'robots_disallowed' WHEN event_type = 'view' THEN 'fetch_error' END
           AS error_kind,
         CASE event_id % 5
           WHEN 0 THEN least(floor(value), 60)::DOUBLE
           WHEN 1 THEN (epoch_us(date_trunc('second', ts + INTERVAL 30 SECOND)) - epoch_us(ts)) / 1e6
           WHEN 4 THEN 60.0 END AS retry_after,
         value AS latency_ms
  FROM events),
log1 AS (
  SELECT *, CASE WHEN error_kind = 'fetch_error' THEN 'timeout_or_network'
                 WHEN error_kind IS NOT NULL THEN 'not_retryable'
                 WHEN status_code = 429 THEN 'rate_limited'
                 WHEN status_code BETWEEN 500 AND 599 THEN 'server_error'
                 ELSE 'not_retryable' END AS error_class
  FROM log0),
log AS (
  SELECT *, error_class = 'not_retryable' OR attempt_no >=
            CASE error_class WHEN 'timeout_or_network' THEN 4 ELSE 3 END AS stops
  FROM log1)"""


@query(f"WITH {LOG} SELECT seq, error_class FROM log")
def fetch_error_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    cls = fetchlog.error_class(F.col("status_code"), F.col("error_kind"))
    return fetch_log(spark, sf_dir).select("seq", cls.alias("error_class"))


@query(f"WITH {LOG} SELECT seq, round(retry_after, 6) AS retry_after FROM log")
def retry_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = fetchlog.retry_after_seconds(F.col("headers"), F.col("ts"))
    return fetch_log(spark, sf_dir).select("seq", F.round(seconds, 6).alias("retry_after"))


@query(
    f"""WITH {LOG}, waits AS (
      SELECT seq, attempt_no, stops, error_class, retry_after, pow(2.0, attempt_no - 1) AS p FROM log)
    SELECT seq, attempt_no::BIGINT AS attempt_no, stops,
           round(CASE error_class WHEN 'rate_limited' THEN coalesce(retry_after, least(p, 60.0))
                 WHEN 'server_error' THEN least(p, 30.0)
                 WHEN 'timeout_or_network' THEN least(0.2 * p, 2.0) ELSE 0.0 END, 6) AS wait_min,
           round(CASE error_class WHEN 'rate_limited' THEN coalesce(retry_after, least(p, 60.0))
                 WHEN 'server_error' THEN least(p, 30.0) * 1.25
                 WHEN 'timeout_or_network' THEN least(0.2 * p, 2.0) * 1.5 ELSE 0.0 END, 6) AS wait_max
    FROM waits"""
)
def retry_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = fetchlog.attempts(fetch_log(spark, sf_dir))
    return classified.select(
        "seq",
        F.col("attempt_no").cast("long").alias("attempt_no"),
        "stops",
        F.round("wait_min", 6).alias("wait_min"),
        F.round("wait_max", 6).alias("wait_max"),
    )


@query(
    f"""WITH {LOG}, per_url AS (
      SELECT url, count(*) AS logged_attempts, bool_or(stops) AS finished,
             coalesce(min(attempt_no) FILTER (WHERE stops), max(attempt_no)) AS final FROM log GROUP BY url)
    SELECT url, logged_attempts, finished, final AS attempt_no, seq, status_code::BIGINT AS status_code,
           error_class, CASE WHEN coalesce(error_kind, '') <> 'robots_disallowed'
                             THEN error_class <> 'not_retryable' END AS breaker_failure
    FROM per_url JOIN log USING (url) WHERE attempt_no = final"""
)
def retry_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    final = fetchlog.outcomes(fetchlog.attempts(fetch_log(spark, sf_dir)))
    return final.select(
        "url",
        "logged_attempts",
        "finished",
        F.col("attempt_no").cast("long").alias("attempt_no"),
        "seq",
        F.col("status_code").cast("long").alias("status_code"),
        "error_class",
        "breaker_failure",
    )


@query(
    f"""WITH {LOG}
    SELECT domain, count(*) AS fetches,
           round(avg((coalesce(status_code BETWEEN 200 AND 299, FALSE) AND error_kind IS NULL)::INT), 6)
             AS success_rate,
           round(quantile_disc(latency_ms, 0.95), 6) AS p95_latency_ms
    FROM log GROUP BY domain"""
)
def latency_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = fetchlog.latency_stats(fetch_log(spark, sf_dir), accuracy=1_000_000)
    return stats.select(
        "domain",
        "fetches",
        F.round("success_rate", 6).alias("success_rate"),
        F.round("p95_latency_ms", 6).alias("p95_latency_ms"),
    )


@query(
    f"""WITH {LOG}
    SELECT domain, date_trunc('month', ts)::DATE AS month, count(*) AS fetches,
           round(avg((coalesce(status_code BETWEEN 200 AND 299, FALSE) AND error_kind IS NULL)::INT), 6)
             AS success_rate, TRUE AS within_bound
    FROM log GROUP BY ALL"""
)
def latency_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly percentiles from stored daily sketches, their ranks held against the log."""
    log = fetch_log(spark, sf_dir)
    root = fresh_root(spark, "latency")
    zones.save_sketches(sketches.daily_latencies(log), root, "latency")
    monthly = sketches.latency_by_month(zones.read_sketches(spark, root, "latency"))
    found = log.withColumn("month", F.trunc("ts", "month")).join(
        monthly.select("domain", "month", F.col("latency_ms").alias("p95")), ["domain", "month"]
    )
    # the error has no hard bound: twice what 99 of 100 estimates keep is passed by almost none
    low, high = 0.95 - 2 * sketches.RANK_ERROR, 0.95 + 2 * sketches.RANK_ERROR
    ranks = found.groupBy("domain", "month").agg(
        (F.count_if(F.col("latency_ms") <= F.col("p95")) >= low * F.count("latency_ms")).alias("above"),
        (F.count_if(F.col("latency_ms") < F.col("p95")) <= high * F.count("latency_ms")).alias("below"),
    )
    return monthly.join(ranks, ["domain", "month"]).select(
        "domain", "month", "fetches", F.round("success_rate", 6).alias("success_rate"),
        (F.col("above") & F.col("below")).alias("within_bound"),
    )


RESULTS = """
results AS (
  SELECT 'd' || user_id % 10 AS domain, ts, event_id AS seq,
         event_type IN ('error', 'signup') AS failed FROM events),
islands AS (
  SELECT *, count(*) FILTER (WHERE NOT failed) OVER w AS island FROM results
  WINDOW w AS (PARTITION BY domain ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)),
streaks AS (
  SELECT *, CASE WHEN failed THEN row_number() OVER (PARTITION BY domain, island ORDER BY ts, seq)
            - (island > 0)::INT ELSE 0 END AS streak
  FROM islands),
timeline AS (
  SELECT domain, ts, seq, failed, streak,
         CASE WHEN coalesce(lag(streak) OVER d, 0) < 3 THEN 'closed'
              WHEN epoch_us(ts) - epoch_us(lag(ts) OVER d) >= 60000000 THEN 'half_open'
              ELSE 'open' END AS state_before,
         failed AND streak >= 3 AS open_after,
         CASE WHEN failed AND streak >= 3 THEN ts END AS opened_at
  FROM streaks WINDOW d AS (PARTITION BY domain ORDER BY ts, seq))"""


@query(f"WITH {RESULTS} SELECT * FROM timeline")
def breaker_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    timeline = breaker.breaker_timeline(fetch_results(spark, sf_dir), fail_max=3)
    return naive(timeline.withColumn("streak", F.col("streak").cast("long")))


@query(
    f"""WITH {RESULTS}
    SELECT domain, max(ts) FILTER (WHERE NOT failed) AS last_success_at,
           arg_max(streak, seq) AS consecutive_failures, arg_max(open_after, seq) AS breaker_open
    FROM (SELECT domain, ts, failed, streak, open_after,
                 row_number() OVER (PARTITION BY domain ORDER BY ts, seq) AS seq FROM timeline)
    GROUP BY domain"""
)
def site_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive(breaker.domain_health(fetch_results(spark, sf_dir), fail_max=3))


@query(
    """WITH arrivals AS (
      SELECT 'd' || user_id % 10 AS domain, ts, event_id AS seq,
             (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id % 10)) / 1e6 AS t,
             row_number() OVER (PARTITION BY user_id % 10 ORDER BY ts, event_id) AS k
      FROM events),
    peaks AS (
      SELECT *, max(t - (k - 1) * 1000.0) OVER (PARTITION BY domain ORDER BY ts, seq
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS peak
      FROM arrivals)
    SELECT domain, seq,
           round(coalesce(greatest(0.0, (k - 1) * 1000.0 + peak - 2000.0 - t), 0.0), 3) AS delay_seconds,
           coalesce(greatest(0.0, (k - 1) * 1000.0 + peak - 2000.0 - t), 0.0) > 1e-9 AS violates
    FROM peaks"""
)
def rate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = fetch_results(spark, sf_dir).select(
        "domain", "ts", "seq", F.lit(0.001).alias("rps"), F.lit(3).alias("burst")
    )
    audited = pacing.audit_admissions(requests)
    return audited.select(
        "domain", "seq", F.round("delay_seconds", 3).alias("delay_seconds"), "violates"
    )


@query(
    """SELECT source AS domain, doc_id AS ordinal,
           row_number() OVER (PARTITION BY source ORDER BY doc_id) AS position,
           greatest(0.0, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 5) / 2.0)
             AS admit_after_seconds
    FROM documents"""
)
def rate_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    frontier = table(spark, sf_dir, "documents").select(
        F.col("source").alias("domain"),
        F.col("doc_id").alias("ordinal"),
        F.lit(2.0).alias("rps"),
        F.lit(5).alias("burst"),
    )
    planned = pacing.plan_frontier(frontier, chunk_rows=500)
    return planned.select("domain", "ordinal", "position", "admit_after_seconds")


@query(
    """SELECT s_suppkey, round(CASE WHEN s_suppkey % 3 <> 0 AND delay > 0 THEN least(2.0, 1.0 / delay)
                                    ELSE 2.0 END, 6) AS effective_rps
    FROM (SELECT *, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_nationkey / 8.0 END AS delay
          FROM supplier)"""
)
def effective_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    delay = F.when(F.col("s_suppkey") % 4 != 0, F.col("s_nationkey") / 8.0)
    rate = pacing.effective_rps(F.lit(2.0), F.col("s_suppkey") % 3 != 0, delay)
    return supplier.select("s_suppkey", F.round(rate, 6).alias("effective_rps"))


@query(
    """WITH targets AS (
      SELECT page_id, url, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS origin,
             regexp_extract(url, '^https?://[^/?#]*(.*)$', 1) AS path FROM pages)
    SELECT page_id,
           CASE length(origin) % 5
             WHEN 0 THEN NOT starts_with(path, '/en/')
             WHEN 1 THEN NOT (starts_with(path, '/en/9') OR starts_with(path, '/es'))
             WHEN 2 THEN TRUE ELSE FALSE END AS allowed,
           CASE WHEN length(origin) % 5 = 0 THEN 5.0 END AS crawl_delay
    FROM targets"""
)
def robots_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    frontier = table(spark, sf_dir, "pages").select("page_id", "url")
    policies = robots_rules.robots_policies(robots(spark, sf_dir), "millbot/1.0")
    checked = robots_rules.check_robots(frontier, policies)
    return checked.select("page_id", "allowed", "crawl_delay")


@query(
    """SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS domain,
           regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS origin FROM pages"""
)
def url_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gristmill.functions import origin

    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", authority(url).alias("domain"), origin(url).alias("origin")
    )


SHAPES = """
shapes AS (
  SELECT doc_id, source AS site_id, text, CASE
    WHEN doc_id % 7 IN (0, 3) THEN 'empty_or_js_shell'
    WHEN doc_id % 7 = 2 THEN 'soft_block'
    WHEN doc_id % 7 IN (4, 5) THEN 'ok'
    WHEN length(trim(text, chr(10) || ' ')) < 50 THEN 'empty_or_js_shell'
    ELSE 'ok' END AS response_class
  FROM documents)"""


@query(f"WITH {SHAPES} SELECT doc_id, response_class FROM shapes")
def response_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify(document_pages(spark, sf_dir)).select("doc_id", "response_class")


@query(
    """WITH cut AS (
      SELECT page_id, regexp_extract(regexp_replace(regexp_replace(regexp_replace(html,
        '(?s)<!--.*?-->', '', 'g'), '(?is)<script\\b.*?</script\\s*>', '<i>', 'g'),
        '(?is)<style\\b.*?</style\\s*>', '<i>', 'g'),
        '(?is)<body\\b[^>]*>(.*?)(?:</body\\s*>|\\z)', 1) AS body FROM pages),
    plain AS (
      SELECT page_id, regexp_replace(replace(replace(regexp_replace(body,
        '\\s*<[/!?A-Za-z][^>]*>\\s*', '', 'g'), '&quot;', '"'), '&nbsp;', chr(160)),
        '&[A-Za-z]+;', '&', 'g') AS text FROM cut)
    SELECT page_id, length(text) AS visible_chars, sha256(text) AS text_hash,
           CASE WHEN regexp_matches(lower(text), 'just a moment|captcha|access denied|unusual traffic')
                  THEN 'soft_block'
                WHEN length(text) < 50 THEN 'empty_or_js_shell' ELSE 'ok' END AS response_class
    FROM plain"""
)
def page_visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of pages in four spellings that a parser reads alike: as they are, without body tags,
    with a `>` in a quoted attribute of the body, and with a tag of very many attributes."""
    pages = table(spark, sf_dir, "pages")
    many = F.repeat(F.lit(' data-x="a>b" y=\'<i>\''), 3000)
    spelling, html = F.col("page_id") % 4, F.col("html")
    respelled = (
        F.when(spelling == 1, F.regexp_replace(html, "</?body>", ""))
        .when(spelling == 2, F.replace(html, F.lit("<body>"), F.lit('<BODY class="a>b" id=c>')))
        .when(spelling == 3, F.replace(html, F.lit("<article>"), F.concat(F.lit("<article"), many, F.lit(">"))))
        .otherwise(html)
    )
    shown = pages.select("page_id", classify.visible_text(respelled).alias("text"))
    return shown.select(
        "page_id",
        F.length("text").cast("long").alias("visible_chars"),
        F.sha2("text", 256).alias("text_hash"),
        classify.response_class(F.lit(200), F.lit("text/html"), F.col("text")).alias(
            "response_class"
        ),
    )


@query(
    f"""WITH {SHAPES}
    SELECT doc_id,
           CASE WHEN response_class = 'empty_or_js_shell' AND doc_id % 2 = 0 THEN 'browser' ELSE 'http' END
             AS fetched_by,
           response_class = 'empty_or_js_shell' AND doc_id % 2 = 1 AS needs_render,
           CASE WHEN response_class = 'empty_or_js_shell' AND doc_id % 2 = 0
                THEN sha256('<html><body><p>' || replace(replace(replace(replace(text, '&', '&amp;'),
                  '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</p></body></html>') END AS rendered_hash
    FROM shapes"""
)
def escalation_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = classify.classify(document_pages(spark, sf_dir))
    merged = classify.escalate(classified, rendered_pages(spark, sf_dir))
    rendered_hash = F.when(F.col("fetched_by") == "browser", F.sha2(F.col("body"), 256))
    return merged.select(
        "doc_id", "fetched_by", "needs_render", rendered_hash.alias("rendered_hash")
    )


@query(
    f"""WITH {SHAPES}
    SELECT site_id, count(*) FILTER (WHERE response_class <> 'empty_or_js_shell')
             AS http_only_fetch_count,
           count(*) FILTER (WHERE response_class = 'empty_or_js_shell' AND doc_id % 2 = 0)
             AS escalated_fetch_count
    FROM shapes GROUP BY site_id"""
)
def escalation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = classify.classify(document_pages(spark, sf_dir))
    merged = classify.escalate(classified, rendered_pages(spark, sf_dir))
    return classify.fetch_stats(merged, keys=("site_id",))


@query(
    """WITH net AS (
      SELECT user_id, dayofyear(ts) AS fetch_id, event_id,
             CASE event_type WHEN 'view' THEN 'xhr' WHEN 'click' THEN 'fetch' ELSE 'image' END AS kind,
             event_id % 9 <> 0 AS has_body, props FROM events)
    SELECT user_id::VARCHAR AS page_url, fetch_id::BIGINT AS fetch_id, event_id::VARCHAR AS url,
           sha256(props) AS body
    FROM net WHERE kind <> 'image' AND has_body
      AND fetch_id = (SELECT max(fetch_id) FROM net o WHERE o.user_id = net.user_id)"""
)
def xhr_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "view", "xhr").when(F.col("event_type") == "click", "fetch")
    network_log = events.select(
        F.col("user_id").cast("string").alias("page_url"),
        F.dayofyear("ts").cast("long").alias("fetch_id"),
        F.col("event_id").cast("string").alias("url"),
        kind.otherwise("image").alias("resource_type"),
        F.lit(200).alias("status_code"),
        F.lit("application/json").alias("content_type"),
        F.when(F.col("event_id") % 9 != 0, F.encode("props", "UTF-8")).alias("body"),
    )
    captured = fetchlog.xhr_captures(network_log)
    return captured.select("page_url", "fetch_id", "url", F.sha2("body", 256).alias("body"))
