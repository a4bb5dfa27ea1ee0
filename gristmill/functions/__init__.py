"""Column functions shared by the operators."""

from gristmill.functions.dates import parse_datetime, run_id_from
from gristmill.functions.hashing import content_hash, record_id, sha256_hex
from gristmill.functions.money import currency_code, decimal_price, price_digits
from gristmill.functions.text import clean_article_text, let, nfkc_strip, quoted, strip
from gristmill.functions.urls import authority, origin, percent_encode, resolve_url, stored_url

__all__ = [
    "authority",
    "clean_article_text",
    "content_hash",
    "currency_code",
    "decimal_price",
    "let",
    "nfkc_strip",
    "origin",
    "parse_datetime",
    "percent_encode",
    "price_digits",
    "quoted",
    "record_id",
    "resolve_url",
    "run_id_from",
    "sha256_hex",
    "stored_url",
    "strip",
]
