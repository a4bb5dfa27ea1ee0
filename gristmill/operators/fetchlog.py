"""Fetch-log analytics: error classes, retry waits and outcomes, network captures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill import fixed_values as V
from gristmill.functions import strip
from gristmill.functions.text import let

FETCH_ERROR = "fetch_error"  # error_kind of a network failure or timeout
ROBOTS_DISALLOWED = "robots_disallowed"

_CLOCK = r"(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?"
# day, month, year, clock, zone: with spaces or dashes, with or without weekday and seconds
_DATED = r"^(?:[A-Za-z]+,?\s*)?(\d{1,2})[ -]+([A-Za-z]{3})[A-Za-z]*[ -]+(\d{2}|\d{4})\s+" + _CLOCK + r"\s*([A-Za-z]+|[+-]\d{4})?$"
# month, day, clock, year: the C library's form
_ASCTIME = r"^(?:[A-Za-z]+,?\s+)?([A-Za-z]{3})\s+(\d{1,2})\s+" + _CLOCK + r"\s+(\d{4})$"
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def http_date(value: Column) -> Column:
    """The instant that an HTTP date names in any of its three forms, else null.

    Seconds may be missing. Two-digit years from 69 on lie in the last century. A date without a zone, or
    with a name that is not known, is in UTC.
    """

    def part(pattern: str, group: int) -> Column:
        return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))

    def either(dated: int, asctime: int) -> Column:
        return F.coalesce(part(_DATED, dated), part(_ASCTIME, asctime))

    year = part(_DATED, 3)
    short = year.cast("int") + F.when(year.cast("int") >= 69, 1900).otherwise(2000)
    year = F.coalesce(F.when(F.length(year) == 2, short).otherwise(year.cast("int")), part(_ASCTIME, 6).cast("int"))
    place = F.instr(F.lit(_MONTHS), F.lower(either(2, 1)))
    month = F.when(place % 3 == 1, ((place + 2) / 3).cast("int"))
    second = F.coalesce(either(6, 5).cast("int"), F.lit(0))
    local = F.try_make_timestamp(
        year, month, either(1, 2).cast("int"), either(4, 3).cast("int"), either(5, 4).cast("int"),
        F.when(second < 60, second), F.lit("UTC"),
    )
    zone = F.coalesce(part(_DATED, 7), F.lit("GMT"))
    minutes = F.substring(zone, 2, 2).try_cast("int") * 60 + F.substring(zone, 4, 2).try_cast("int")
    named = F.create_map(*[F.lit(v) for item in V.ZONE_HOURS.items() for v in item])
    offset = F.when(zone.startswith("+"), minutes).when(zone.startswith("-"), -minutes)
    offset = F.coalesce(offset, F.try_element_at(named, F.upper(zone)) * 60, F.lit(0))
    return F.timestamp_micros(F.unix_micros(local) - offset.cast("long") * 60_000_000)


def error_class(status_code: Column, error_kind: Column) -> Column:
    """`rate_limited`, `server_error`, `timeout_or_network` or `not_retryable`."""
    return (
        F.when(error_kind == FETCH_ERROR, "timeout_or_network")
        .when(error_kind.isNotNull(), "not_retryable")
        .when(status_code == 429, "rate_limited")
        .when(status_code.between(500, 599), "server_error")
        .otherwise("not_retryable")
    )


def retry_after_seconds(headers: Column, now: Column) -> Column:
    """Seconds asked for by a Retry-After header, within 0 to 60; null if absent or unreadable."""
    named = F.map_filter(headers, lambda name, _: F.lower(name) == "retry-after")
    value = strip(F.get(F.map_values(named), F.lit(0)))
    target = let(value, http_date)
    delta = (F.unix_micros(target) - F.unix_micros(now)) / F.lit(1e6)
    clamped = F.greatest(F.lit(0.0), F.least(delta, F.lit(V.RETRY_AFTER_MAX)))
    return F.when(
        value.rlike("^[0-9]+$"), F.least(value.cast("double"), F.lit(V.RETRY_AFTER_MAX))
    ).when(target.isNotNull(), clamped)


def wait_bounds(cls: Column, attempt_no: Column, header_wait: Column) -> tuple[Column, Column]:
    """Shortest and longest wait after an attempt; they differ by the random jitter."""
    doubled = F.pow(F.lit(2.0), attempt_no - 1)
    limited = F.coalesce(header_wait, F.least(V.SERVER_ERROR_BASE * doubled, F.lit(V.RETRY_AFTER_MAX)))
    server = F.least(V.SERVER_ERROR_BASE * doubled, F.lit(V.SERVER_ERROR_MAX))
    network = F.least(V.TIMEOUT_BASE * doubled, F.lit(V.TIMEOUT_MAX))

    def by_class(server_wait: Column, network_wait: Column) -> Column:
        return (
            F.when(cls == "rate_limited", limited)
            .when(cls == "server_error", server_wait)
            .when(cls == "timeout_or_network", network_wait)
            .otherwise(0.0)
        )

    return (
        by_class(server, network),
        by_class(server * (1 + V.SERVER_ERROR_JITTER), network * (1 + V.TIMEOUT_JITTER)),
    )


def attempts(log: DataFrame) -> DataFrame:
    """The fetch log with class, wait bounds and the retry decision of every attempt.

    The total attempt number is held against the budget of the *current* error's class.
    """
    cls = error_class(F.col("status_code"), F.col("error_kind"))
    budget = F.lit(0)
    for name, tries in V.ATTEMPT_BUDGET.items():
        budget = F.when(F.col("error_class") == name, tries).otherwise(budget)
    out = log.withColumn("error_class", cls).withColumn(
        "retry_after", retry_after_seconds(F.col("headers"), F.col("ts"))
    )
    low, high = wait_bounds(F.col("error_class"), F.col("attempt_no"), F.col("retry_after"))
    return out.withColumns(
        {
            "wait_min": low,
            "wait_max": high,
            "stops": (F.col("error_class") == "not_retryable") | (F.col("attempt_no") >= budget),
        }
    )


def outcomes(classified: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """The final outcome of each fetch: its first attempt that stops, else the last one logged.

    A fetch is known by `keys`, by default site, domain, URL and, in a log that has it, `run_id`: a log of
    several runs has a fetch of the same page in each.

    `breaker_failure` is true for a surviving 429/5xx or an exhausted network failure, false for
    anything else, and null for a robots disallow, which says nothing about the domain's health.
    """
    if keys is None:
        keys = [c for c in ("site_id", "run_id", "domain", "url") if c != "run_id" or c in classified.columns]
    last = F.struct("ts", "seq", "status_code", "error_kind", "error_class", "attempt_no")
    stopped = F.min_by(last, F.when(F.col("stops"), F.col("attempt_no")))
    final = classified.groupBy(*keys).agg(
        F.count("*").alias("logged_attempts"),
        F.coalesce(stopped, F.max_by(last, "attempt_no")).alias("_last"),
        F.coalesce(F.max("stops"), F.lit(False)).alias("finished"),
    )
    failure = F.when(
        ~F.coalesce(F.col("_last.error_kind") == ROBOTS_DISALLOWED, F.lit(False)),
        F.col("_last.error_class") != "not_retryable",
    )
    return final.select(
        *keys, "logged_attempts", "finished", "_last.*", failure.alias("breaker_failure")
    )


def latency_stats(
    log: DataFrame, keys: Sequence[str] = ("domain",), *, accuracy: int = 10_000
) -> DataFrame:
    """Success rate and 95th percentile latency. The percentile is a logged value whose rank is off
    by at most rows / `accuracy`; it merges sketches of bounded size, however large a domain is."""
    ok = (F.col("status_code").between(200, 299) & F.col("error_kind").isNull()).cast("double")
    return log.groupBy(*keys).agg(
        F.count("*").alias("fetches"),
        F.avg(F.coalesce(ok, F.lit(0.0))).alias("success_rate"),
        F.percentile_approx("latency_ms", 0.95, accuracy).alias("p95_latency_ms"),
    )


def xhr_captures(network_log: DataFrame) -> DataFrame:
    """Data requests (`xhr`, `fetch`) with a body, of the latest fetch of each page only."""
    wanted = network_log.filter(
        F.col("resource_type").isin("xhr", "fetch") & F.col("body").isNotNull()
    )
    latest = network_log.groupBy("page_url").agg(F.max("fetch_id").alias("fetch_id"))
    return wanted.join(latest, ["page_url", "fetch_id"], "left_semi").select(
        "page_url", "fetch_id", "url", "status_code", "content_type", "body"
    )
