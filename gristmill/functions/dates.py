"""Timestamps and run ids."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import strip

# strptime directive -> (variable-width, fixed-width) Java datetime letters
_DIRECTIVES = {
    "Y": ("yyyy", "yyyy"),
    "m": ("M", "MM"),
    "d": ("d", "dd"),
    "H": ("H", "HH"),
    "I": ("h", "hh"),
    "M": ("m", "mm"),
    "S": ("s", "ss"),
    "f": ("SSSSSS", "SSSSSS"),
    "b": ("MMM", "MMM"),
    "B": ("MMMM", "MMMM"),
    "p": ("a", "a"),
    "j": ("D", "DDD"),
    "z": ("[XXX][XX]", "[XXX][XX]"),
}


def java_pattern(fmt: str) -> str:
    """Translate a strptime format to the pattern `try_to_timestamp` expects.

    Directives that touch another one take their fixed width, since a variable-width field
    would swallow its neighbour's digits. Weekday names cannot be parsed by Spark and are refused.
    """
    tokens = re.findall(r"%(.)|([^%]+)", fmt)
    out = []
    for i, (directive, literal) in enumerate(tokens):
        if literal:
            out.append("".join(f"'{ch}'" if ch.isalpha() else ch for ch in literal))
        elif directive == "%":
            out.append("%")
        elif directive in _DIRECTIVES:
            touching = (i > 0 and tokens[i - 1][0]) or (i + 1 < len(tokens) and tokens[i + 1][0])
            out.append(_DIRECTIVES[directive][1 if touching else 0])
        else:
            raise ValueError(f"unsupported date directive %{directive}")
    return "".join(out)


def parse_datetime(raw: Column, fmt: str) -> Column:
    """Parse `raw` by a strptime format; null when it does not match. Naive values are UTC.

    Needs `spark.sql.session.timeZone=UTC`.
    """
    return F.try_to_timestamp(strip(raw), F.lit(java_pattern(fmt)))


def run_id_from(started_at: Column, token: Column) -> Column:
    """`20260101T000000Z-1a2b3c4d` from a start time and a unique token."""
    stamp = F.date_format(started_at, "yyyyMMdd'T'HHmmss'Z'")
    return F.concat(stamp, F.lit("-"), F.substring(F.replace(token, F.lit("-"), F.lit("")), 1, 8))
