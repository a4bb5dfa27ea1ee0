"""A training corpus from documents: quality, near-duplicates, benchmarks, secrets, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept. Each result is
written as Parquet in the shared folder, read again by the next stage, and dropped when that one's is
written.

Rows: a null or empty text fails the quality rules. Rows with one id are one document, of which near-dedup
keeps one row; rows with a null id all stay. Repeated rows are one row after near-dedup. Columns beyond those
of `documents` are carried along whatever their names, as the last stage's docstring says. Empty
tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.llm import bpe, decontam, minhash, quality_rules, secrets
from gristmill.llm.common import named
from gristmill.session import cut, drop


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    # the rules add columns of their own, which must not meet the caller's
    own = named(docs, docs.columns)
    apart = docs.select(F.col("text"), F.struct(*docs.columns).alias(own[0]))
    return quality_rules.judge(apart).where("kept").select(f"{own[0]}.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    near = minhash.near_duplicates(docs, shingle_words=5, percent=80)
    near = near.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    near = near.agg(F.count(F.lit(1)).alias("rows"), F.max("kept").alias("kept"))
    gone, several = near.where(~F.col("kept")), near.where("kept and rows > 1")
    once = docs.join(gone.unionByName(several).select("doc_id"), "doc_id", "left_anti")
    # rows that share an id are one document; that with the smallest hash stays
    (rank,) = named(docs, ["rank"])
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64(*docs.columns), *docs.columns)
    again = docs.join(several.select("doc_id"), "doc_id", "left_semi").withColumn(rank, F.row_number().over(order))
    return once.unionByName(again.where(F.col(rank) == 1).drop(rank)).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live-looking secrets replaced in their texts."""
    return secrets.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded bytes."""
    return bpe.encode_and_decode(docs, with_ids=True)


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("byte-level BPE", tokenize),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from `documents` to tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, cut(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
        if k:
            drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
