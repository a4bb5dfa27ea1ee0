"""Seen hashes as bucketed tables, so that a lookup shuffles the batch and never the state.

Marks are logged per batch and now and then gathered in a snapshot. Both are tables in the session's
catalog over folders of the root, clustered and sorted by hash into the same number of buckets, which
is fixed when the root is first written. A lookup deals the batch's hashes out into as many
partitions and joins them bucket by bucket. Each bucket's files carry a Bloom filter of their
hashes, so that a point read (`marks_of`) opens one bucket and skips row groups without the hash.
By default there are as many buckets as the session has shuffle partitions at that time.

One job at a time may write to a root. Null hashes are not stored and match nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators.dedupe import HASH, first_per_key
from gristmill.schemas import SEEN_HASHES
from gristmill.session import cut, make_folder

SNAPSHOT_EVERY = 64
COLUMNS = [c.split()[0] for c in SEEN_HASHES.split(", ")]


def _buckets(spark: SparkSession, root: str, wanted: int | None) -> int:
    """The root's number of buckets; `wanted` where none is fixed yet."""
    wanted = wanted or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{root}/state/seen_buckets"
    spark.range(1).select(F.lit(wanted).alias("buckets")).write.mode("ignore").parquet(path)
    return spark.read.schema("buckets int").parquet(path).first()[0]


def _table(spark: SparkSession, root: str, kind: str, buckets: int) -> str:
    """The table's name in this session's catalog, knowing all folders that are there now."""
    name = f"gristmill_seen_{kind}_{hashlib.sha256(root.encode()).hexdigest()[:24]}"
    if not spark.catalog.tableExists(name):
        make_folder(spark, f"{root}/state/seen_{kind}")
        spark.sql(
            f"""CREATE TABLE {name} ({SEEN_HASHES}, batch bigint) USING parquet
            OPTIONS ('parquet.bloom.filter.enabled#{HASH}' 'true')
            PARTITIONED BY (batch) CLUSTERED BY ({HASH}) SORTED BY ({HASH}) INTO {buckets} BUCKETS
            LOCATION '{root}/state/seen_{kind}'"""
        )
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    return name


def _batches(spark: SparkSession, table: str) -> list[int]:
    """Stored batches, from the folders' names alone."""
    return sorted(int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect())


def _stored(
    spark: SparkSession, root: str, before: int, buckets: int, snapshot_before: int | None = None
) -> list[DataFrame]:
    """The newest snapshot and the log since then, of the batches before `before`."""
    log = _table(spark, root, "log", buckets)
    snapshot = _table(spark, root, "snapshot", buckets)
    limit = before if snapshot_before is None else snapshot_before
    last = max((b for b in _batches(spark, snapshot) if b < limit), default=None)
    since = F.col("batch") < before
    if last is None:
        return [spark.table(log).where(since)]
    return [
        spark.table(log).where(since & (F.col("batch") > last)),
        spark.table(snapshot).where(F.col("batch") == last),
    ]


def _together(parts: list[DataFrame]) -> DataFrame:
    narrow = [p.select(*COLUMNS) for p in parts]
    return narrow[0] if len(narrow) == 1 else narrow[0].unionByName(narrow[1])


def read(spark: SparkSession, root: str, *, before: int, buckets: int | None = None) -> DataFrame:
    """All marks of the batches before `before`."""
    return _together(_stored(spark, root, before, _buckets(spark, root, buckets)))


def known(records: DataFrame, root: str, *, before: int, buckets: int | None = None) -> DataFrame:
    """The marks of the hashes in `records`. Only these are shuffled; the state's buckets are streamed
    past a hash table of them."""
    spark = records.sparkSession
    buckets = _buckets(spark, root, buckets)
    wanted = records.select(HASH).where(F.col(HASH).isNotNull()).repartition(buckets, HASH).distinct()
    parts = _stored(spark, root, before, buckets)
    return _together([p.join(wanted.hint("shuffle_hash"), HASH, "left_semi") for p in parts])


def marks_of(
    spark: SparkSession, root: str, hashes: Sequence[str], *, before: int, buckets: int | None = None
) -> DataFrame:
    """The marks of a few given hashes: buckets are pruned and the Bloom filters asked."""
    parts = _stored(spark, root, before, _buckets(spark, root, buckets))
    return _together([p.where(F.col(HASH).isin(list(hashes))) for p in parts])


def _put(rows: DataFrame, table: str, batch: int) -> None:
    # with a fixed partition, no rows empty it too
    into = f"INSERT OVERWRITE TABLE {table} PARTITION (batch = {int(batch)}) SELECT * FROM {{rows}}"
    rows.sparkSession.sql(into, rows=rows)


def save(
    marks: DataFrame,
    root: str,
    batch: int,
    *,
    alive_at: Column,
    buckets: int | None = None,
    every: int = SNAPSHOT_EVERY,
) -> None:
    """Log a batch's marks in place of what an earlier try logged; without marks its folder is empty.

    Every `every` batches all marks that are alive at `alive_at` go into a snapshot, the latest per hash.
    """
    spark = marks.sparkSession
    buckets = _buckets(spark, root, buckets)
    log = _table(spark, root, "log", buckets)
    rows = marks.select(*COLUMNS).where(F.col(HASH).isNotNull())
    _put(rows.repartition(buckets, HASH), log, batch)
    if batch > 0 and batch % every == 0:
        snapshot = _table(spark, root, "snapshot", buckets)
        # an earlier try's snapshot of this batch is not read, since it is replaced
        parts = _stored(spark, root, batch + 1, buckets, snapshot_before=batch)
        latest = [F.desc("first_seen"), F.desc("run_id"), F.desc("site_id")]
        alive = first_per_key(_together(parts).where(F.col("expires_at") > alive_at), [HASH], latest)
        # stored first: a table cannot be replaced by what is read from it
        full = cut(alive.select(*COLUMNS), "seen-snapshot")
        _put(full.repartition(buckets, HASH), snapshot, batch)
