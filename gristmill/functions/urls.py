"""URL columns."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def authority(url: Column) -> Column:
    """Host (and port) part of `url`, the key of pacing and breakers; '' when it has none.

    A split on the delimiters rather than `parse_url`, which refuses URLs with stray characters.
    """
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def origin(url: Column) -> Column:
    """`scheme://host` of `url`, the key of robots rules."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    return F.concat(scheme, F.lit("://"), authority(url))


def percent_encode(c: Column) -> Column:
    """Percent-encode as UTF-8, leaving letters, digits and `_.-~/` alone."""
    c = F.url_encode(c)
    for form, path in (("+", "%20"), ("%2F", "/"), ("*", "%2A"), ("%7E", "~")):
        c = F.replace(c, F.lit(form), F.lit(path))
    return c


def percent_decode(c: Column) -> Column:
    """Undo percent-encoding; `+` and percent signs without two hex digits stay as they are."""
    escaped = F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.try_url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))


def stored_url(url: Column) -> Column:
    """A web URL as it is stored: scheme and host in lower case, no default port, and `/` for an
    empty path. The rest keeps its spelling."""
    pattern = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*://)([^/?#]*)([^?#]*)(.*)$"
    scheme = F.lower(F.regexp_extract(url, pattern, 1))
    host = F.lower(F.regexp_extract(url, pattern, 2))
    default = F.when(scheme == "http://", ":80").when(scheme == "https://", ":443")
    host = F.when(F.endswith(host, default), F.regexp_replace(host, ":[0-9]+$", "")).otherwise(host)
    path = F.regexp_extract(url, pattern, 3)
    path = F.when(path == "", "/").otherwise(path)
    whole = F.concat(scheme, host, path, F.regexp_extract(url, pattern, 4))
    return F.when(scheme == "", url).otherwise(whole)


def _joined(base: str | None, href: str | None) -> str | None:
    if base is None or href is None:
        return None
    try:
        return urljoin(base, href.strip())
    except ValueError:  # such as an unclosed bracket in the host
        return None


@F.pandas_udf(StringType())
def resolve_url(href: pd.Series, base: pd.Series) -> pd.Series:
    """Resolve `href` against `base`; null if either is malformed.

    Spark has no relative-URL resolution, hence Arrow batches.
    """
    return pd.Series([_joined(b, h) for h, b in zip(href, base)], dtype=object)
