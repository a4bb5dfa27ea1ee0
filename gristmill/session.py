"""Session settings, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Rows of a lookup side that may be broadcast; at a few hundred bytes a row this stays well under
# an executor's memory. Larger sides are left to the shuffle join (with AQE's skew handling).
BROADCAST_ROWS = 200_000


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings every job here relies on (UTC) or profits from (AQE, long HTML in Arrow batches)."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few rows as a table whose size the optimizer knows, so that joins broadcast it."""
    struct = StructType.fromDDL(schema)
    columns = [f"col{i + 1}" for i in range(len(struct))]
    literals = F.array(*[F.struct(*[_literal(v) for v in row]) for row in rows])
    out = spark.range(1).select(F.inline(literals).alias(*columns))
    return out.select(
        *[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(columns, struct.fields)]
    )


def _literal(value: object) -> Column:
    return F.struct(*[_literal(v) for v in value]) if isinstance(value, tuple) else F.lit(value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Taken from `spark.checkpoint.dir`. Only a local session without that setting, as in tests,
    gets a temporary folder: on a cluster such a folder would vanish with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="gristmill-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder, wherever the file system of its path is, unless it is there."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: shared by several sinks, safe from
    executor loss, and still columnar (a reader prunes columns and pushes filters down)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/gristmill/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.work_folder = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete the folders of tables that `cut` gave, once all that was read from them is written.

    Until then they must stay: a lost executor's tasks read them again.
    """
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(table.work_folder)
        target.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


# Bounds of one Arrow batch on its way to Python, whatever the length of the texts in it.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by rows and bytes, unless the session already has tighter bounds."""
    for key, bound in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        now = spark.conf.get(key, None)
        number = int(now) if now and now.lstrip("-").isdigit() else 0
        if not 0 < number <= bound:
            spark.conf.set(key, str(bound))


# Inputs below this size may sit in fewer splits than there are cores.
SMALL_INPUT_BYTES = 1 << 30


def spread(df: DataFrame) -> DataFrame:
    """Deal a small input out to all cores ahead of a CPU-bound stage.

    Only done when the optimizer's size estimate stays below a gigabyte, so at most that much is
    shuffled; larger inputs have splits enough and are left where they are.
    """
    spark = df.sparkSession
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except AttributeError:  # no JVM plan at hand, e.g. over Spark Connect
        return df
    if int(str(size)) >= SMALL_INPUT_BYTES:
        return df
    return df.repartition(spark.sparkContext.defaultParallelism)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when a count shows that `df` has at most `max_rows` rows.

    The count stops after `max_rows + 1` rows. Beyond it the join shuffles, with the same result.
    """
    over = df.limit(max_rows + 1).count() > max_rows
    return df if over else F.broadcast(df)
