"""The pipeline's stages in order, against the plain rules, and the registered queries."""

import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in P.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns, name
        assert after.select("doc_id").distinct().join(before.select("doc_id"), "doc_id", "left_anti").isEmpty()
        before = after.cache()
    pieces = P.STAGES[-1][1](spark, before, SF)
    ids = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d"))
    copies = before.groupBy("doc_id").count()
    assert ids.join(copies, "doc_id").filter(F.col("n") != F.col("d") * F.col("count")).isEmpty()


def test_empty(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_registered():
    import __spark_entry__ as E
    names = set(E.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names
