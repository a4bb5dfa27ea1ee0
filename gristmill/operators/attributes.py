"""Attributes of records by path, whatever kind of page the record came from.

Each page kind has attributes of its own, so no fixed struct fits them all. They are kept as VARIANT:
Parquet stores the fields that a file's rows share in columns of their own, and a scan that asks for typed
paths reads just those columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(attributes: Column) -> Column:
    """JSON text as VARIANT; null for null and for text that is not JSON."""
    return F.try_parse_json(attributes)


def typed(records: DataFrame, paths: Mapping[str, tuple[str, str]], attributes: str = "attributes") -> DataFrame:
    """`records` with a column per entry name: (path, type) of `paths`, in place of the VARIANT column.

    A record without the path, or with a value that is not of the type, has null.
    """
    values = [F.try_variant_get(attributes, path, kind).alias(name) for name, (path, kind) in paths.items()]
    return records.select(*[c for c in records.columns if c != attributes], *values)


def by_path(records: DataFrame, attributes: str = "attributes") -> DataFrame:
    """One row per record and attribute: the record's other columns, `path`, `type` and `value`.

    Text is given as it is, any other value as JSON; an attribute that is null has a null value. Records
    without attributes give no row.
    """
    spark = records.sparkSession
    rows = records.where(F.col(attributes).isNotNull())
    each = spark.tvf.variant_explode(F.col(attributes).outer()).select("key", "value")
    rows = rows.lateralJoin(each).where(F.col("key").isNotNull())
    kind = F.schema_of_variant("value")
    text = F.when(kind == "STRING", F.try_variant_get("value", "$", "string")).when(kind != "VOID", F.to_json("value"))
    kept = [c for c in records.columns if c != attributes]
    return rows.select(*kept, F.concat(F.lit("$."), "key").alias("path"), kind.alias("type"), text.alias("value"))
