"""Content hashes and record ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_hex(c: Column) -> Column:
    """SHA-256 of the UTF-8 text, as lower-case hex."""
    return F.sha2(c, 256)


def _joined(separator: str, parts: tuple[Column, ...]) -> Column:
    # concat_ws would skip nulls; an absent part is spelled `None` in the hashed text.
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(separator))
        pieces.append(F.coalesce(part.cast("string"), F.lit("None")))
    return F.concat(*pieces)


def record_id(*parts: Column) -> Column:
    """Hash of `part:part:...`, e.g. site and URL."""
    return sha256_hex(_joined(":", parts))


def content_hash(*parts: Column) -> Column:
    """Hash of `part|part|...`, e.g. title, price digits and availability."""
    return sha256_hex(_joined("|", parts))
