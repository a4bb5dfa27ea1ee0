"""Response classification and escalation to rendered copies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill import fixed_values as V
from gristmill.functions import let, strip

# Named character references whose character matters to the text rules; any other reference
# counts as one character.
_REFERENCES = (("&nbsp;", "\xa0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"))
# What follows a tag's name up to its `>`. Quotes hide a `>` only where a value begins; what is never
# closed runs to the end. Every part is possessive, so one pass over a tag decides and no state is
# kept for its attributes, however many there are.
_REST = r"(?:[^>=]++|=[ \t\n\f\r]*+(?:\"[^\"]*+(?:\"|\z)|'[^']*+(?:'|\z))?+)*+(?:>|\z)"
_END = r"(?=[ \t\n\f\r/>]|\z)"
# All markup: comments, script and style with what is in them, title with its text (2), start tags by
# their name (3), end tags and declarations.
_MARKUP = (
    rf"(?is)<!--.*?(?:-->|\z)|<(script|style){_END}{_REST}.*?(?:</\1{_END}[^>]*+(?:>|\z)|\z)"
    rf"|<title{_END}{_REST}(.*?)(?:</title{_END}[^>]*+(?:>|\z)|\z)"
    rf"|<([a-z][^ \t\n\f\r/>]*+){_REST}|</[a-z]{_REST}|<[!?/][^>]*+(?:>|\z)"
)
# Start tags that do not open the body.
_HEAD = ("html", "head", "meta", "link", "base", "basefont", "bgsound", "noscript", "noframes", "template")
_SPACES = " \t\n\f\r"


def visible_text(html: Column) -> Column:
    """Body text without script and style: text nodes stripped, then joined without separator.

    In Catalyst throughout, in one scan over the markup. As for a parser, the body begins with its
    tag, or without one with the first tag that cannot stand in a head or the first text outside
    the title; what follows the body's end tag still belongs to it.
    """
    # each piece of markup becomes: separator, tag name, separator, title text, separator
    zero, marks = "\0", "\0$3\0$2\0"
    pieces = F.split(F.regexp_replace(F.replace(html, F.lit(zero), F.lit("")), _MARKUP, marks), zero)
    # pieces go by threes: text, the name of the tag behind it, the title behind it

    def opens(piece: Column, k: Column) -> Column:
        tag = (k % 3 == 1) & (piece != "") & ~F.lower(piece).isin(*_HEAD)
        return tag | ((k % 3 == 0) & (F.btrim(piece, F.lit(_SPACES)) != ""))

    def shown(pieces: Column) -> Column:
        begins = F.transform(pieces, lambda piece, k: F.when(opens(piece, k), k))
        return let(F.array_min(begins), lambda first: F.filter(pieces, lambda p, k: (k >= first) & (k % 3 != 1)))

    # references are resolved per text node, so that text itself is computed only once
    text = F.array_join(F.transform(let(pieces, shown), lambda node: strip(_resolved(node))), "")
    return F.coalesce(text, F.lit(""))


def _resolved(text: Column) -> Column:
    """Text with its character references replaced."""
    out = text
    for name, char in _REFERENCES:
        out = F.replace(out, F.lit(name), F.lit(char))
    out = F.regexp_replace(out, r"&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);", "&")
    return F.when(F.contains(text, F.lit("&")), out).otherwise(text)


def response_class(status_code: Column, content_type: Column, text: Column) -> Column:
    """`ok`, `soft_block` or `empty_or_js_shell`, from the visible text.

    Only 2xx HTML is looked into (a missing content type counts as HTML); the soft-block markers
    are tried before the length.
    """

    def by_text(text: Column, lowered: Column) -> Column:
        marked = reduce(or_, (F.contains(lowered, F.lit(m)) for m in V.SOFT_BLOCK_MARKERS))
        short = F.length(text) < V.MIN_VISIBLE_CHARS
        return F.when(marked, "soft_block").when(short, "empty_or_js_shell").otherwise("ok")

    inspected = let(text, lambda t: let(F.lower(t), lambda low: by_text(t, low)))
    return F.when(inspectable(status_code, content_type), inspected).otherwise("ok")


def inspectable(status_code: Column, content_type: Column) -> Column:
    """Whether a response is 2xx and HTML as far as its content type says."""
    not_html = (content_type != "") & ~F.contains(F.lower(content_type), F.lit("html"))
    return status_code.between(200, 299) & ~F.coalesce(not_html, F.lit(False))


def classify(pages: DataFrame) -> DataFrame:
    """`pages(status_code, content_type, body, ...)` with `response_class`."""
    text = visible_text(F.make_valid_utf8(F.col("body").cast("string")))
    cls = response_class(F.col("status_code"), F.col("content_type"), text)
    return pages.withColumn("response_class", cls)


COPY = ("status_code", "headers", "body", "fetched_at", "content_type")


def escalate(
    classified: DataFrame, rendered: DataFrame, keys: Sequence[str] = ("site_id", "run_id", "url")
) -> DataFrame:
    """Plain copies, with the rendered copy in place of each empty or JS-shell page.

    Adds `fetched_by` (`http` or `browser`) and `needs_render` (a shell whose rendered copy is
    missing). Soft blocks and failures keep their plain copy. Only shells enter the join, so pages
    that need no rendering are not shuffled.
    """
    shell = F.col("response_class") == "empty_or_js_shell"
    plain = classified.filter(~shell).withColumns(
        {"fetched_by": F.lit("http"), "needs_render": F.lit(False)}
    )
    copies = rendered.select(*keys, F.struct(*COPY).alias("_copy"))
    # the class of a shell is known from here on and need not be worked out again
    shells = classified.filter(shell).withColumn("response_class", F.lit("empty_or_js_shell"))
    joined = shells.join(copies, list(keys), "left")
    found = F.col("_copy").isNotNull()
    replaced = joined.select(
        *[
            F.when(found, F.col(f"_copy.{name}")).otherwise(F.col(name)).alias(name)
            if name in COPY
            else F.col(name)
            for name in classified.columns
        ],
        F.when(found, "browser").otherwise("http").alias("fetched_by"),
        (~found).alias("needs_render"),
    )
    return plain.unionByName(replaced)


def fetch_stats(escalated: DataFrame, keys: Sequence[str] = ("site_id", "run_id")) -> DataFrame:
    """How many fetches were served by plain HTTP and how many needed a browser."""
    shell = F.col("response_class") == "empty_or_js_shell"
    return escalated.groupBy(*keys).agg(
        F.count_if(~shell).alias("http_only_fetch_count"),
        F.count_if(shell & (F.col("fetched_by") == "browser")).alias("escalated_fetch_count"),
    )
