"""Text clean-up columns."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gristmill import fixed_values as V

# All characters that count as whitespace.
WHITESPACE = "".join(chr(cp) for cp in range(0x3001) if chr(cp).isspace())


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once, however often `use` mentions it.

    A filter pushed below a projection repeats an expensive expression for every mention; a lambda
    variable is not repeated.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column) -> Column:
    """Drop leading and trailing Unicode whitespace (`trim` only drops U+0020)."""
    return F.btrim(c, F.lit(WHITESPACE))


# Texts that are Python strings at a time, of the many in an Arrow batch.
PART_TEXTS = 64


@F.arrow_udf(StringType())
def nfkc_strip(text: pa.Array) -> pa.Array:
    """NFKC form, stripped. Spark has no normalization function, hence Arrow batches."""
    done = []
    for at in range(0, len(text), PART_TEXTS):
        part = text.slice(at, PART_TEXTS).to_pylist()
        part = [t if t is None else unicodedata.normalize("NFKC", t).strip() for t in part]
        done.append(pa.array(part, text.type))
    return pa.concat_arrays(done) if done else text


def clean_article_text(c: Column) -> Column:
    """Remove citation markers, spaces before punctuation and repeated whitespace.

    Whitespace is made plain and single first; then the space before a punctuation mark is one
    fixed pair of characters, which needs no pattern.
    """
    c = F.regexp_replace(c, V.CITATION_MARKER.replace("%s", WHITESPACE), "")
    c = F.translate(c, WHITESPACE, " " * len(WHITESPACE))
    c = F.regexp_replace(c, " {2,}", " ")
    for mark in V.CLOSING_PUNCTUATION:
        c = F.replace(c, F.lit(" " + mark), F.lit(mark))
    return strip(c)


def quoted(c: Column) -> Column:
    """The value in quotes, as it appears inside a rejection reason."""
    escaped = c
    for raw, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\xa0", "\\xa0")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(shown))
    double = F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"'))
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(single)
