"""Registered queries over a whole table against their SQL, and the pipeline against brute force."""

import corpus_pipeline
from compare import differences, duck
from gristmill.llm import registry

SMALL = "/root/testdata/sf0.001"


def test_queries_equal_their_sql(spark):
    registry.load_all()
    connection = duck(SMALL)
    for name, sql in registry.ORACLES.items():
        assert differences(spark, connection, SMALL, registry.QUERIES[name], sql) == []


def test_every_query_returns_its_whole_table(spark):
    registry.load_all()
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for name in ("op1_substring_dedup", "op4_decontamination", "op6_minhash", "op7_byte_bpe", "op8_secrets", "op9_toxicity"):
        assert registry.QUERIES[name](spark, SMALL).select("doc_id").distinct().count() == n


def test_stages_only_shrink(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == names
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert 0 < docs.count() <= before
        before = docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == before
