"""Small helpers that the operators share."""

from __future__ import annotations

import math
import sys
import types
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.session import bounded_batches as bounded_batches


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out when the scan has fewer splits than the cluster has cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def worker_state() -> dict:
    """What one Python worker keeps from task to task.

    The package travels to the workers by value, so its own module variables are new in every task.
    """
    home = sys.modules.setdefault("_gristmill_worker", types.ModuleType("_gristmill_worker"))
    return home.__dict__.setdefault("state", {})


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once, however often `body` mentions it."""
    return F.transform(F.array(value), body)[0]


def named(df: DataFrame, columns: Sequence[str], prefix: str = "") -> list[str]:
    """Names for working columns that no column of `df` has (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for c in columns:
        name = f"{prefix}{c}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of a text column over all rows."""
    return df.select(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def parts(total: int, each: int, least: int = 1) -> int:
    return max(least, math.ceil(total / each))
