"""Chat formatting: tool calls linked to their results, in order, checked and in canonical JSON.

Calls and results are joined by (conversation, call id). Of several calls with one id the first in the
conversation counts, and of several results the first that stands after it; `n_repeats` counts the other
calls and `n_results` all results of the id, early ones too. Calls are ordered topologically: by depth (1 + that of the call whose result they wait
for, `after`), then turn, then id. Depths are found by following `after` links with pointer doubling,
so a chain of any length takes logarithmic rounds; calls on a cycle get a null depth and come last.
Sorting a conversation's rows by (depth, turn, call_id) gives the order; no task holds a conversation.
Arguments are validated against the schemas by tool: required names, known names and JSON types.
Each call is serialised as JSON with sorted keys and no spaces.

Rows: null ids link with nothing. Null or broken argument JSON is invalid, not an error; so are NaN, infinite
or overlong numbers and values nested too deep to read. Lone surrogates stay `\\u` escapes. Null texts
are JSON null. Results without a turn stand after no call. An unknown tool makes a call invalid. Extra columns are not carried along. No rows
in, none out.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import bounded_batches
from gristmill.session import cut

KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict}


def _finite(text: str) -> float:
    value = float(text)
    if not math.isfinite(value):
        raise ValueError(text)
    return value


def parsed(arguments: str | None) -> object:
    """The value of JSON text, strictly: no NaN and no number that a double cannot hold."""
    return json.loads(arguments or "", parse_float=_finite, parse_constant=_finite)


def fault(tool: str | None, arguments: str | None, schemas: Mapping[str, dict]) -> str | None:
    """Why the arguments do not fit the tool's schema, or None."""
    schema = schemas.get(tool or "")
    if schema is None:
        return "unknown tool"
    try:
        value = parsed(arguments)
    except ValueError:
        return "not JSON"
    except RecursionError:
        return "nested too deep"
    if not isinstance(value, dict):
        return "not an object"
    known = schema.get("properties", {})
    for name in schema.get("required", ()):
        if name not in value:
            return f"missing {name}"
    for name in sorted(value):
        if name not in known:
            return f"unexpected {name}"
        kind, v = known[name].get("type"), value[name]
        if kind and (not isinstance(v, KINDS[kind]) or (isinstance(v, bool) and kind != "boolean")):
            return f"{name} is not {kind}"
        if "enum" in known[name] and v not in known[name]["enum"]:
            return f"{name} is not listed"
    return None


def _escaped(text: str) -> str:
    """Lone surrogates, which no encoding holds, as escapes."""
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value: object) -> str:
    """JSON with sorted keys and no spaces."""
    return _escaped(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False))


def serialised(tool: str | None, arguments: str | None, call_id: str | None, result: str | None, why: str | None) -> str:
    """A call as canonical JSON; arguments that are no JSON, or too deep to write, are null."""
    value = None if why in ("not JSON", "unknown tool", "nested too deep") else parsed(arguments)
    try:
        return canonical({"arguments": value, "id": call_id, "name": tool, "result": result})
    except RecursionError:
        return canonical({"arguments": None, "id": call_id, "name": tool, "result": result})


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) of calls (conv_id, call_id, after); null on a cycle."""
    key = ["conv_id", "call_id"]
    known = calls.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("real"))
    now = calls.join(known, ["conv_id", "after"], "left").select(
        *key, F.when(F.col("real"), F.col("after")).alias("up"), F.when(F.col("real"), 1).otherwise(0).alias("depth")
    )
    now = cut(now, "chat-depths")
    rounds, longest = 0, 1
    total = calls.count()
    while longest <= total and not now.where("up IS NOT NULL").isEmpty():
        above = now.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        now = now.join(above, ["conv_id", "up"], "left").select(
            *key, F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
        )
        now = cut(now, "chat-depths")
        rounds, longest = rounds + 1, longest * 2
    return now.select(*key, F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def link(calls: DataFrame, results: DataFrame, schemas: Mapping[str, dict]) -> DataFrame:
    """One row per call (conv_id, turn, call_id, tool, arguments, after) with its result (conv_id,
    turn, call_id, content): depth, place in the conversation, fault, linked, n_repeats,
    n_results and json."""
    key = ["conv_id", "call_id"]
    known = F.col("call_id").isNotNull() & F.col("conv_id").isNotNull()
    # the hash orders calls of one id alike with and without their arguments at hand
    first = ["turn", "tool", "h", "after"]
    calls = calls.withColumn("h", F.xxhash64("arguments"))
    narrow = calls.where(known).groupBy(*key).agg(F.min(F.struct(*first)).alias("c"))
    depth = depths(cut(narrow.select(*key, "c.after"), "chat-calls"))
    # the first call's turn meets the results, narrow, before one of them is chosen; each text moves once
    asked = narrow.select(*key, F.col("c.turn").alias("asked"))
    answers = results.where(known).select(*key, F.struct("turn", "content").alias("r")).join(asked, key)
    after = F.when(F.col("r.turn") > F.col("asked"), F.col("r"))
    answers = answers.groupBy(*key).agg(F.min(after).alias("r"), F.count("r").alias("n_results"))
    one = calls.where(known).groupBy(*key).agg(
        F.min(F.struct(*first, "arguments")).alias("c"), (F.count("*") - 1).alias("n_repeats")
    )
    one = one.join(answers, key, "left").join(depth, key, "left").select(
        *key, "c.turn", "c.tool", "c.arguments", "n_repeats", F.coalesce("n_results", F.lit(0)).alias("n_results"), "depth",
        F.col("r.content").alias("content"), F.col("r").isNotNull().alias("linked"),
    )
    zero = F.lit(0).cast("long")
    alone = calls.where(~known).select(
        *key, "turn", "tool", "arguments", zero.alias("n_repeats"), zero.alias("n_results"), F.lit(False).alias("linked")
    )
    joined = one.unionByName(alone, allowMissingColumns=True)
    schemas = dict(schemas)

    @F.pandas_udf("fault string, json string")
    def finished(tool: pd.Series, arguments: pd.Series, call_id: pd.Series, content: pd.Series, depth: pd.Series) -> pd.DataFrame:
        out = []
        for t, a, c, r, d in zip(tool, arguments, call_id, content, depth, strict=True):
            why = fault(t, a, schemas)
            why = why or ("cycle" if c is not None and pd.isna(d) else None)
            out.append((why and _escaped(why), serialised(t, a, c, r, why)))
        return pd.DataFrame(out, columns=["fault", "json"])

    bounded_batches(calls.sparkSession)
    return joined.withColumn("f", finished("tool", "arguments", "call_id", "content", "depth")).select(
        *key, "turn", "tool", "depth", "linked", "n_repeats", "n_results", "f.fault", "f.json"
    )
