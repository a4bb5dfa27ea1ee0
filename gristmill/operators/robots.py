"""Robots compliance of a frontier."""

from __future__ import annotations

from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.urls import origin, percent_decode, percent_encode

POLICY = "rules array<struct<path:string,allowed:boolean>>, crawl_delay double"


def robots_policies(robots: DataFrame, user_agent: str) -> DataFrame:
    """The rules that hold for `user_agent`, parsed once per origin: `(origin, rules, crawl_delay)`.

    `robots(origin, status_code, body)`: 200 is parsed; any other 4xx means there are no rules;
    everything else (5xx, null for a network failure) means the policy is unknown: deny all.
    """

    @F.pandas_udf(POLICY)
    def parse(body: pd.Series) -> pd.DataFrame:
        out = []
        for text in body:
            parser = RobotFileParser()
            parser.parse((text or "").splitlines())
            groups = [g for g in parser.entries if g.applies_to(user_agent)]
            group = groups[0] if groups else parser.default_entry
            lines = group.rulelines if group else []
            delay = group.delay if group else None
            out.append(
                (
                    [{"path": line.path, "allowed": line.allowance} for line in lines],
                    None if delay is None else float(delay),
                )
            )
        return pd.DataFrame(out, columns=["rules", "crawl_delay"])

    rules_type = "array<struct<path:string,allowed:boolean>>"
    parsed = robots.filter(F.col("status_code") == 200).select(
        "origin", parse(F.coalesce("body", F.lit(""))).alias("_p")
    )
    deny_all = F.array(F.struct(F.lit("/").alias("path"), F.lit(False).alias("allowed")))
    others = robots.filter(~F.coalesce(F.col("status_code") == 200, F.lit(False))).select(
        "origin",
        F.when(F.col("status_code").between(400, 499), F.array().cast(rules_type))
        .otherwise(deny_all)
        .cast(rules_type)
        .alias("rules"),
        F.lit(None).cast("double").alias("crawl_delay"),
    )
    return parsed.select("origin", "_p.rules", "_p.crawl_delay").unionByName(others)


def robots_path(url: Column) -> Column:
    """Everything after the host, decoded once and encoded again, as rule paths are."""
    decoded = percent_decode(url)
    rest = F.regexp_replace(decoded, r"^[A-Za-z][A-Za-z0-9+.\-]*:", "")
    rest = F.regexp_replace(rest, r"^//[^/?#]*", "")
    # an empty fragment and an empty query leave no mark
    rest = F.regexp_replace(rest, r"(?s)^([^#]*)#$", "$1")
    rest = F.regexp_replace(rest, r"(?s)^([^?#]*)\?(?=#|$)", "$1")
    encoded = percent_encode(rest)
    return F.when(encoded == "", F.lit("/")).otherwise(encoded)


def check_robots(frontier: DataFrame, policies: DataFrame) -> DataFrame:
    """The frontier with `allowed` and `crawl_delay`.

    The first rule whose path is a prefix decides, no rule means allowed, and an origin without a
    policy row is unknown: denied. There is one policy row per origin, so the join grows neither
    side; an origin with very many URLs is split by AQE.
    """
    matching = F.filter(
        "rules", lambda r: (r["path"] == "*") | F.startswith(F.col("_path"), r["path"])
    )
    decided = F.coalesce(F.get(matching, F.lit(0))["allowed"], F.lit(True))
    keyed = frontier.withColumns({"_origin": origin(F.col("url")), "_path": robots_path(F.col("url"))})
    return keyed.join(policies.withColumnRenamed("origin", "_origin"), "_origin", "left").select(
        *frontier.columns,
        F.when(F.col("rules").isNull(), False).otherwise(decided).alias("allowed"),
        "crawl_delay",
    )
