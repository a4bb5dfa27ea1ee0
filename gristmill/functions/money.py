"""Price and currency columns."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from gristmill import fixed_values as V
from gristmill.functions.text import strip

PRICE_TYPE = DecimalType(38, 10)

# Characters that count as digits: all decimal digits, plus the superscripts, subscripts and
# circled digits, which are kept by the filter and then make the number unparseable.
_DECIMAL_DIGITS = [
    chr(cp) for cp in range(0x80, 0x20000) if unicodedata.category(chr(cp)) == "Nd"
]
_OTHER_DIGITS = "".join(
    chr(cp)
    for cp in range(0x80, 0x20000)
    if chr(cp).isdigit() and unicodedata.category(chr(cp)) != "Nd"
)


def price_digits(raw: Column) -> Column:
    """Digits and dots of `raw` as a canonical decimal string; null when they form no number.

    Leading zeros go, trailing zeros stay (`010.50` -> `10.50`, `.5` -> `0.5`, `5.` -> `5`), so
    the string can be hashed. Signs, separators and symbols are ignored, whatever they meant.
    """
    kept = F.regexp_replace(raw, rf"[^\p{{Nd}}{_OTHER_DIGITS}.]", "")
    kept = F.when(
        kept.rlike(r"[^0-9.]"),
        F.translate(
            kept,
            "".join(_DECIMAL_DIGITS),
            "".join(str(unicodedata.decimal(d)) for d in _DECIMAL_DIGITS),
        ),
    ).otherwise(kept)
    whole = F.regexp_extract(kept, r"^0*([0-9]*)", 1)
    fraction = F.regexp_extract(kept, r"\.([0-9]+)$", 1)
    canonical = F.concat(
        F.when(whole == "", F.lit("0")).otherwise(whole),
        F.when(fraction == "", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
    )
    return F.when(kept.rlike(r"^([0-9]+\.?[0-9]*|\.[0-9]+)$"), canonical)


def decimal_price(raw: Column) -> Column:
    """`raw` as a decimal; null when it holds no parseable number."""
    return price_digits(raw).try_cast(PRICE_TYPE)


def currency_code(raw: Column) -> Column:
    """Currency of the leading symbol; null when there is none."""
    stripped = strip(raw)
    code = F.lit(None).cast("string")
    for symbol, iso in V.CURRENCY_BY_SYMBOL.items():
        code = F.when(stripped.startswith(symbol), F.lit(iso)).otherwise(code)
    return code
