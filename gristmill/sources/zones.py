"""Zone tables under one root folder: raw, staging, curated, quarantine, reports and state.

A job writes staging, attributes, curated, quarantine and reports under an attempt number of its own and names
that attempt in the commit table last. Readers see, of each site and run, the rows of the newest
committed attempt only: what a repeat no longer has is gone, a job that broke off is not seen, and a
run without rows is known to have none. Raw pages and state logs replace their own partitions.
One job at a time may write to a root.
"""

from __future__ import annotations

import gzip
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, LongType, StringType, StructType

from gristmill import schemas
from gristmill.functions import stored_url
from gristmill.operators.attributes import parsed
from gristmill.operators.dedupe import first_per_key
from gristmill.operators.quality import BATCH
from gristmill.schemas import RECORD_COLUMNS


def _replace(df: DataFrame, path: str, *partitions: str, file_format: str = "parquet") -> None:
    # Rebalancing writes few files per partition, and AQE splits a site that holds most rows.
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .format(file_format)
        .save(path)
    )


# Types of the folder names; left to inference, a site called 007 would be read as 7.
PARTITIONS = {
    "site": StringType(), "domain": StringType(), "dt": DateType(), "run": StringType(), "attempt": LongType(),
}


def _read(
    spark: SparkSession, path: str, schema: str | StructType | None, file_format: str = "parquet"
) -> DataFrame:
    """Files of a folder; with `schema`, a folder not yet written is empty."""
    try:
        if schema is None:
            found = spark.read.option("mergeSchema", "true").format(file_format).load(path).schema
            schema = StructType()
            for field in found.fields:
                schema.add(field.name, PARTITIONS.get(field.name, field.dataType))
        return spark.read.schema(schema).format(file_format).load(path)
    except AnalysisException as error:
        if schema is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_zone(
    spark: SparkSession, root: str, zone: str, schema: str | StructType | None = None
) -> DataFrame:
    """A zone's committed rows, with columns of all its files. Filters on the partition columns
    (site or domain, dt, run) prune folders, and so does the join with the committed attempts, a row
    per site and run. With `schema`, a zone not yet written is empty."""
    site, file_format = ZONES[zone]
    wanted = names = None
    if schema is not None:
        given = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        names, wanted = given.names, StructType(list(given.fields))
        for name in (site, "run", "attempt"):
            if name not in names:
                wanted.add(name, PARTITIONS.get(name, StringType()))
    rows = _read(spark, f"{root}/{zone}", wanted, file_format)
    valid = committed(spark, root)
    valid = valid.select(F.col("site_id").alias(site), F.col("run_id").alias("run"), "attempt")
    rows = rows.join(valid, [site, "run", "attempt"], "left_semi")
    return rows.select(*(names or [c for c in rows.columns if c != "attempt"]))


# Zone: the column that holds the site, and the files' format.
ZONES = {
    "staging": ("site", "parquet"),
    "attributes": ("site", "parquet"),
    "curated": ("domain", "parquet"),
    "quarantine": ("site", "json"),
    "reports": ("site_id", "parquet"),
}


@dataclass(frozen=True)
class Job:
    """The numbers of one job's try: `batch` stays over repeats, `attempt` is new each time."""

    batch: int
    attempt: int


CLAIMS = "run_id string, batch bigint, attempt bigint"
COMMITS = "site_id string, run_id string, staged bigint, curated bigint, quarantined bigint, attempt bigint"


def claim(spark: SparkSession, runs: DataFrame, root: str, batch: int | None = None) -> Job:
    """Numbers for a job over `runs`. Without `batch`, a job over just the runs of an earlier one is a
    repeat and keeps its number; any other gets the next one."""
    path = f"{root}/state/claims"
    own = runs.select("run_id").distinct().withColumn("own", F.lit(1))
    before = _read(spark, path, CLAIMS)
    jobs = before.join(own, "run_id", "left").groupBy("attempt", "batch")
    jobs = jobs.agg(F.count("*").alias("n"), F.count("own").alias("own"))
    same = (F.col("own") == own.count()) & (F.col("own") == F.col("n"))
    last = jobs.agg(F.max("attempt"), F.max("batch"), F.max(F.when(same, F.col("batch")))).first()
    attempt = 0 if last[0] is None else last[0] + 1
    if batch is None:
        batch = last[2] if last[2] is not None else 0 if last[1] is None else last[1] + 1
    _replace(
        own.select("run_id", F.lit(batch).cast("bigint").alias("batch"), F.lit(attempt).cast("bigint").alias("attempt")),
        path, "attempt",
    )
    return Job(batch, attempt)


def commit(
    runs: DataFrame, root: str, attempt: int, **written: DataFrame
) -> None:
    """Make an attempt the valid one of its runs, with the rows that it has `staged`, `curated` and
    `quarantined`. The last write of a job."""
    rows = runs.select(*BATCH).distinct()
    for name in ("staged", "curated", "quarantined"):
        part = written.get(name)
        if part is None:
            rows = rows.withColumn(name, F.lit(0).cast("bigint"))
            continue
        counts = part.groupBy(*BATCH).agg(F.count("*").alias(name))
        rows = rows.join(counts, list(BATCH), "left").fillna(0, [name])
    _replace(rows.withColumn("attempt", F.lit(attempt).cast("bigint")), f"{root}/state/commits", "attempt")


def committed(spark: SparkSession, root: str) -> DataFrame:
    """The valid attempt of each site and run, and how many rows it stored."""
    return first_per_key(_read(spark, f"{root}/state/commits", COMMITS), list(BATCH), [F.desc("attempt")])


def inventory(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Objects whose key (path below `root`) starts with `prefix`: key, size and change time.

    Only the file listing is read, never the contents, and only that of the folder the prefix names.
    """
    base = root.rstrip("/") + "/"
    # up to the first character that a path pattern would read otherwise
    folder = re.split(r"[][{}*?^\\]", prefix)[0].rpartition("/")[0]
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base + folder)
    except AnalysisException as error:
        if not folder or error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], RAW_FILES)
    # a listing shows the full URI; the key is what follows the root folder
    key = F.element_at(F.split("path", r"\Q" + base + r"\E", 2), -1)
    return files.select(key.alias("key"), "length", "modificationTime").filter(
        F.startswith("key", F.lit(prefix))
    )


def url_hash(url: Column) -> Column:
    """Short name of a URL in the raw zone."""
    return F.substring(F.sha2(url, 256), 1, 16)


def write_raw(pages: DataFrame, root: str) -> None:
    """Store fetched pages as they came, whatever their status, before anything parses them."""
    rows = pages.withColumns(
        {
            "url_hash": url_hash(F.col("url")),
            "site": F.col("site_id"),
            "dt": F.to_date("fetched_at"),
            "run": F.col("run_id"),
        }
    )
    _replace(rows, f"{root}/raw", "site", "dt", "run")


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    """Stored pages for another parse; filter on `site`, `dt` or `run` to prune."""
    return _read(spark, f"{root}/raw", None)


RAW_FILES = "path string, modificationTime timestamp, length bigint, content binary, site string, dt date, run string"


def write_raw_files(pages: DataFrame, root: str) -> DataFrame:
    """Store each page's body as one `.html.gz` object in site=/dt=/run= folders below `root`, a folder
    that all executors reach; gives the keys and packed sizes of what was stored.

    Tasks write the objects, under names that follow from the page alone and in one piece, so a task that
    is run again writes the same objects. Of several pages with one key the last wins. For very many
    pages `write_raw` packs them into few files. The names of sites and runs are percent-encoded, as
    Spark does in folder names. Objects are written when the result is evaluated.
    """
    rows = pages.select(
        F.concat_ws(
            "/",
            F.concat(F.lit("site="), _folder(F.col("site_id"))),
            F.concat(F.lit("dt="), F.to_date("fetched_at").cast("string")),
            F.concat(F.lit("run="), _folder(F.col("run_id"))),
            F.concat(url_hash(F.col("url")), F.lit(".html.gz")),
        ).alias("key"),
        F.struct("fetched_at", "page_ord", F.coalesce("body", F.lit(b"")).alias("body")).alias("page"),
    )
    last = rows.groupBy("key").agg(F.max("page").alias("page")).select("key", "page.body")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", root) if ":/" in root else f"file://{root}")
        for batch in batches:
            sizes = []
            for key, body in zip(*(batch.column(c).to_pylist() for c in ("key", "body")), strict=True):
                packed = gzip.compress(body, mtime=0)
                target = f"{base}/{key}"
                files.create_dir(target.rpartition("/")[0], recursive=True)
                part = f"{target}.{uuid.uuid4().hex}.part"
                with files.open_output_stream(part) as out:
                    out.write(packed)
                files.move(part, target)
                sizes.append(len(packed))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sizes, pa.int64())], names=["key", "length"])

    return last.mapInArrow(store, "key string, length long")


def _folder(c: Column) -> Column:
    # the characters that Spark's own folder names escape; a reader turns them back
    for sign in '%"#\'*/:=?\\{[]^':
        c = F.replace(c, F.lit(sign), F.lit(f"%{ord(sign):02X}"))
    return c


@F.arrow_udf(BinaryType())
def _unpacked(content: pa.Array) -> pa.Array:
    return pa.array([None if b is None else gzip.decompress(b) for b in content.to_pylist()], pa.binary())


def read_raw_files(spark: SparkSession, path: str) -> DataFrame:
    """Pages kept as single `.html.gz` objects in site=/dt=/run= folders: the partition columns as their
    folders spell them (`007` is no number), `url_hash`, the packed `length` and the unpacked `body`.

    A filter on site, dt or run lists the folders that match and opens no other object; one on `length`
    is judged on the listing. Without `body` no object is unpacked. One object must fit a task.
    """
    files = spark.read.schema(RAW_FILES).format("binaryFile").option("pathGlobFilter", "*.html.gz")
    name = F.regexp_extract("path", r"([^/]+)\.html\.gz$", 1).alias("url_hash")
    return files.option("basePath", path).load(path).select(
        "site", "dt", "run", name, "length", _unpacked("content").alias("body")
    )


def records_out(records: DataFrame) -> DataFrame:
    """The sixteen stored columns: price as double, attributes as JSON text, and the URL in its
    stored form (the record id hashes it as extracted)."""
    renamed = {
        "source_url": stored_url(F.col("source_url")).alias("source_url"),
        "price": F.col("price").cast("double").alias("price"),
        "attributes": F.col("attributes").alias("attributes_json"),
    }
    return records.select(*[renamed.get(name, F.col(name)) for name in RECORD_COLUMNS])


def _dated(rows: DataFrame, site: str, started: DataFrame) -> DataFrame:
    days = started.select(*BATCH, F.to_date("started_at").alias("dt"))
    return rows.join(days, list(BATCH)).withColumns({site: F.col("site_id"), "run": F.col("run_id")})


def _attempted(rows: DataFrame, attempt: int) -> DataFrame:
    return rows.withColumn("attempt", F.lit(attempt).cast("bigint"))


def write_staging(records: DataFrame, runs: DataFrame, root: str, attempt: int = 0) -> None:
    """All kept records, whatever their gate says."""
    rows = _attempted(_dated(records_out(records), "site", runs), attempt)
    _replace(rows, f"{root}/staging", "site", "dt", "run", "attempt")


def write_attributes(records: DataFrame, runs: DataFrame, root: str, attempt: int = 0) -> None:
    """Attributes of all kept records as VARIANT, apart from the published columns."""
    rows = records.select("record_id", *BATCH, parsed(F.col("attributes")).alias("attributes"))
    _replace(_attempted(_dated(rows, "site", runs), attempt), f"{root}/attributes", "site", "dt", "run", "attempt")


def write_curated(promoted: DataFrame, runs: DataFrame, root: str, attempt: int = 0) -> None:
    """Records of batches that passed or warned."""
    rows = _attempted(_dated(records_out(promoted), "domain", runs), attempt)
    _replace(rows, f"{root}/curated", "domain", "dt", "run", "attempt")


def write_quarantine(rejects: DataFrame, runs: DataFrame, root: str, attempt: int = 0) -> None:
    """Rejected rows as JSON lines. The run is part of the key: a second run on the same day adds
    to the first one's rejects instead of replacing them."""
    rows = _attempted(_dated(rejects, "site", runs), attempt)
    _replace(rows, f"{root}/quarantine", "site", "dt", "run", "attempt", file_format="json")


def write_report(reports: DataFrame, root: str, attempt: int = 0) -> None:
    """Quality reports, one row per batch."""
    rows = _attempted(reports.withColumn("run", F.col("run_id")), attempt)
    _replace(rows, f"{root}/reports", "run", "attempt")


SITE_ERRORS = "site_id string, run_id string, pages bigint, error string, attempt bigint"


def write_site_errors(errors: DataFrame, root: str, attempt: int = 0) -> None:
    """What a job could not process, and why."""
    _replace(_attempted(errors, attempt), f"{root}/site_errors", "attempt")


def read_site_errors(spark: SparkSession, root: str) -> DataFrame:
    """Site errors of the newest attempt of each job, which its claims tell."""
    claims = _read(spark, f"{root}/state/claims", CLAIMS)
    newest = claims.groupBy("batch").agg(F.max("attempt").alias("attempt")).select("attempt")
    return _read(spark, f"{root}/site_errors", SITE_ERRORS).join(newest, "attempt", "left_semi").drop("attempt")


def latest_reports(reports: DataFrame) -> DataFrame:
    """The newest report of each site."""
    return first_per_key(reports, ["site_id"], [F.desc("generated_at"), F.desc("run_id")])


# ---- state tables: logs of changes, one partition per batch, with a full snapshot now and then --

SNAPSHOT_EVERY = 64


def append_state(rows: DataFrame, path: str, batch: int) -> None:
    """Add a batch's rows to a log, replacing what an earlier try of it wrote."""
    _replace(rows.withColumn("batch", F.lit(batch).cast("long")), path, "batch")


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of a log; empty if nothing was written yet."""
    return _read(spark, path, f"{schema}, batch bigint")


def save_state(
    changes: DataFrame,
    path: str,
    schema: str,
    key: str,
    batch: int,
    *,
    alive: Column | None = None,
    every: int = SNAPSHOT_EVERY,
) -> None:
    """Log a batch's changes; every `every` batches also store the whole state.

    Reading the state thus never goes back further than the last snapshot. `alive` is the rows a
    snapshot keeps, e.g. those that have not expired.
    """
    spark = changes.sparkSession
    append_state(changes, f"{path}/log", batch)
    if batch > 0 and batch % every == 0:
        state = load_state(spark, path, schema, key, before=batch + 1, snapshot=batch - 1)
        append_state(state if alive is None else state.filter(alive), f"{path}/snapshot", batch)


def load_changes(
    spark: SparkSession,
    path: str,
    schema: str,
    *,
    before: int,
    every: int = SNAPSHOT_EVERY,
    snapshot: int | None = None,
) -> DataFrame:
    """Newest stored snapshot and the changes since, of the batches before `before`. Batch numbers
    may have gaps: without a snapshot the whole log counts. `snapshot` limits which one may be used;
    `every` is taken for the sake of callers, as snapshots are found and not computed."""
    log = read_log(spark, f"{path}/log", schema).filter(F.col("batch") < before)
    stored = read_log(spark, f"{path}/snapshot", schema)
    limit = before - 1 if snapshot is None else snapshot
    last = stored.filter(F.col("batch") <= limit).agg(F.max("batch")).first()[0]
    if last is None:
        return log
    return log.filter(F.col("batch") > last).unionByName(stored.filter(F.col("batch") == last))


def load_state(
    spark: SparkSession, path: str, schema: str, key: str, *, before: int, **limits
) -> DataFrame:
    """The last row of each key: point reads are a filter on this."""
    changes = load_changes(spark, path, schema, before=before, **limits)
    return first_per_key(changes, [key], [F.desc("batch")]).drop("batch")


def upsert(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """`table` with `changes` put over it by `key`: the changed row wins."""
    kept = table.join(changes.select(key), key, "left_anti")
    return kept.unionByName(changes)


def save_sketches(sketches: DataFrame, root: str, name: str) -> None:
    """Store daily sketches, replacing those of the same days."""
    _replace(sketches, f"{root}/sketches/{name}", "dt")


def read_sketches(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Stored daily sketches; a filter on `dt` prunes days."""
    return _read(spark, f"{root}/sketches/{name}", None)


def save_manifests(manifests: DataFrame, root: str, batch: int) -> None:
    """Store run manifests."""
    append_state(manifests, f"{root}/state/runs", batch)


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Run manifests, the last saved one per run."""
    log = read_log(spark, f"{root}/state/runs", schemas.RUN_MANIFEST)
    return first_per_key(log, ["run_id"], [F.desc("batch")]).drop("batch")


def save_site_state(states: DataFrame, root: str, batch: int) -> None:
    """Store site states, e.g. from `domain_health`."""
    path = f"{root}/state/sites"
    save_state(states, path, schemas.SITE_STATE, "site_id", batch)


def read_site_state(spark: SparkSession, root: str, *, before: int) -> DataFrame:
    """The last saved state per site."""
    return load_state(spark, f"{root}/state/sites", schemas.SITE_STATE, "site_id", before=before)
