"""The registered queries: each applies one operator to its whole table and derives the
columns of its contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import bitsliced_search, divergence, exact_dedup, merkle, mixing, near_dedup, oracle, packing, sharding, suffix_dedup, surrogates, topk_search, toxicity, warc_store
from rollbook.llm.common import shared_path

SHARDS = 24


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix_sources(_read(spark, sf_dir, "documents"))
    return (m.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))))
            .select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).alias("taken"), "copies"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = near_dedup.near_groups(_read(spark, sf_dir, "documents"), shingle=2, percent=80)
    return g.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
                    F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = suffix_dedup.remove_repeats(_read(spark, sf_dir, "documents"), length=400)
    return r.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), vocabulary()).withColumnRenamed("id", "doc_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc_store.write_archive(_read(spark, sf_dir, "pages"), path)
    return (warc_store.read_archive(spark, path)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sharding.interleave(_read(spark, sf_dir, "documents"), SHARDS)
    return s.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
                    "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "embeddings")
    return topk_search.top_k(e, e.filter(F.col("vec_id") % 100 == 0))


#: Key of the surrogates; a deployment passes its own secret.
SURROGATE_KEY = "rollbook"


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = surrogates.replace_entities(_read(spark, sf_dir, "documents"), SURROGATE_KEY)
    kinds = F.array_sort(F.array_distinct(F.transform("entities", surrogates.kind_of)))
    return r.select("doc_id", "text", F.size("entities").alias("n_entities"), F.array_join(kinds, ",").alias("kinds"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = exact_dedup.exact_groups(_read(spark, sf_dir, "documents"))
    return g.select(F.col("id").alias("doc_id"), "keep_id", "group_size",
                    F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256"))


def training_row(doc_id: Column) -> Column:
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 != 1


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model | None:
    rows = toxicity.training_rows(docs, labels, training_row)
    return toxicity.fit([t for t, _ in rows], [y for _, y in rows])


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    s = toxicity.score(docs, toxicity_model(docs, _read(spark, sf_dir, "labels")))
    return s.select(F.col("id").alias("doc_id"), F.coalesce(~training_row(F.col("id")), F.lit(False)).alias("held_out"),
                    "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = divergence.quality(_read(spark, sf_dir, "documents"))
    return q.select(F.col("id").alias("doc_id"), *divergence.COUNTS, "base_failed", "kept", "char_distance", "word_distance")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = bitsliced_search.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), k=10)
    return r.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _read(spark, sf_dir, "documents")
    row = lambda text: merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0, F.lit(False))
    leaves = d.select(F.col("doc_id").alias("id"), "source", row(F.col("text")).alias("leaf"), F.when(hit, row(lower)).alias("tampered"))
    m = merkle.manifest(leaves.select("id", "source", "leaf", F.coalesce("tampered", "leaf").alias("claim")))
    return m.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
                    F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_near_dedup, op3_suffix_dedup, op4_pack, op5_warc, op6_shards, op7_topk, op8_surrogates, op9_exact_dedup,
                                   op10_toxicity, op11_quality, op12_lexical_search, op13_manifest)}
ORACLES = oracle.SQL
