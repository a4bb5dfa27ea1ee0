"""Attributes as VARIANT, by path and with types."""

import pytest

from pyspark.sql import functions as F

from gristmill.operators import attributes


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows = [
        ("a", '{"rating":3,"image_url":"x","more":{"k":[1,"two",null]}}'),
        ("b", '{"author":"me","tags":["p","q"],"rating":"three"}'),
        ("c", "not JSON {"),
        ("d", None),
        ("e", "{}"),
        ("f", '{"rating":null,"flag":true,"n":1.5}'),
        ("g", '["no object"]'),
    ]
    path = str(tmp_path_factory.mktemp("attributes"))
    df = spark.createDataFrame(rows, "record_id string, attributes string")
    df.withColumn("attributes", attributes.parsed(F.col("attributes"))).write.parquet(f"{path}/t")
    return spark.read.parquet(f"{path}/t")


def test_by_path(stored):
    got = {(r.record_id, r.path): (r.type, r.value) for r in attributes.by_path(stored).collect()}
    assert got == {
        ("a", "$.rating"): ("BIGINT", "3"),
        ("a", "$.image_url"): ("STRING", "x"),
        ("a", "$.more"): (got["a", "$.more"][0], '{"k":[1,"two",null]}'),
        ("b", "$.author"): ("STRING", "me"),
        ("b", "$.tags"): ("ARRAY<STRING>", '["p","q"]'),
        ("b", "$.rating"): ("STRING", "three"),
        ("f", "$.rating"): ("VOID", None),
        ("f", "$.flag"): ("BOOLEAN", "true"),
        ("f", "$.n"): ("DECIMAL(2,1)", "1.5"),
    }


def test_typed_paths_reach_the_scan(stored):
    paths = {"rating": ("$.rating", "bigint"), "second": ("$.tags[1]", "string"), "k": ("$.more.k[0]", "int")}
    out = attributes.typed(stored, paths)
    got = {r.record_id: (r.rating, r.second, r.k) for r in out.collect()}
    none = (None, None, None)
    assert got == {"a": (3, None, 1), "b": (None, "q", None)} | dict.fromkeys("cdefg", none)
    scan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<record_id:string,attributes:struct<0:bigint,1:string,2:int>>" in scan
