"""Table schemas. Records keep the published column order."""

from __future__ import annotations

RAW_PAGES = (
    "site_id string, run_id string, page_ord int, url string, status_code int, "
    "headers map<string,string>, body binary, fetched_at timestamp, content_type string"
)
FETCH_LOG = (
    "site_id string, domain string, url string, attempt_no int, seq bigint, ts timestamp, "
    "status_code int, error_kind string, headers map<string,string>, latency_ms double"
)
NETWORK_LOG = (
    "fetch_id bigint, page_url string, url string, resource_type string, status_code int, "
    "content_type string, body binary"
)
ROBOTS = "origin string, status_code int, body string"
FRONTIER = "site_id string, ordinal int, url string, max_scroll_rounds int"
SITE_REGISTRY = (
    "id string, module string, enabled boolean, schedule string, strategy string, "
    "rate_limit struct<rps:double,burst:int,respect_crawl_delay:boolean>, dq_profile string"
)
DQ_PROFILES = "profile string, dimension string, warn_threshold double, fail_threshold double"
RUNS = "run_id string, site_id string, started_at timestamp, scraper_version string, backend string"
SEEN_HASHES = (
    "content_hash string, site_id string, first_seen timestamp, expires_at timestamp, run_id string"
)
QUARANTINE = (
    "site_id string, source_url string, run_id string, quarantined_at timestamp, reason string, "
    "payload map<string,string>"
)
RUN_MANIFEST = (
    "run_id string, started_at timestamp, finished_at timestamp, "
    "site_counts map<string,bigint>, error_counts map<string,bigint>, git_sha string"
)
SITE_STATE = (
    "site_id string, last_success_at timestamp, consecutive_failures bigint, breaker_open boolean"
)

RECORD_COLUMNS = (
    "record_id",
    "site_id",
    "source_url",
    "content_hash",
    "run_id",
    "scraped_at",
    "scraper_version",
    "fetch_strategy",
    "backend",
    "title",
    "price",
    "currency",
    "availability",
    "attributes",
    "completeness_score",
    "extraction_method",
)
