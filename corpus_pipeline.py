"""The corpus pipeline: toxicity filter, exact dedup, near dedup, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept;
its result is written as Parquet in the shared folder and read again.  All but the last
return the columns of ``documents``; the last returns the pieces of the packed windows.
Empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollbook.llm import exact_dedup, mixing, near_dedup, packing, queries, toxicity
from rollbook.llm.common import written


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic; everything else stays."""
    model = queries.toxicity_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    return near_dedup.drop_near_copies(docs, shingle=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, queries.vocabulary()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", remove_toxic),
    ("exact dedup", remove_exact_copies),
    ("near dedup", remove_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: A trained model, MinHash components and a tokenizer are beyond SQL; tests use a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
