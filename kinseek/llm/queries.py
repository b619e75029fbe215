"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from kinseek.llm.embedding_dedup import near_vectors
from kinseek.llm.fingerprints import edited_fingerprints
from kinseek.llm.html_extract import extract_text
from kinseek.llm.license_scan import license_summary
from kinseek.llm.mixing import mix_sources
from kinseek.llm.ngram_jaccard import jaccard_groups
from kinseek.llm.packing import pack_documents
from kinseek.llm.periodic_runs import find_runs, planted, strongest
from kinseek.llm.pii import find_personal_data
from kinseek.llm.sharding import shard_documents
from kinseek.llm.source_divergence import divergence
from kinseek.llm.substring_dedup import dedup_substrings
from kinseek.llm.toxicity import toxicity

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups(_table(spark, folder, "documents"), size=4, num=85, den=100)


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = shard_documents(_table(spark, folder, "documents"), shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal_data(_table(spark, folder, "documents"))


def op4_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(_table(spark, folder, "pages"))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_substrings(_table(spark, folder, "documents"), window=13, keep_text=False).drop("kept")


def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(_table(spark, folder, "embeddings"), least=0.93)


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(_table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(_table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(_table(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence(_table(spark, folder, "documents"), least=30, top=50)


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = find_runs(planted(_table(spark, folder, "documents")), least=24, periods=3)
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("_best", strongest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "_best.start",
        "_best.length",
        "_best.period",
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_summary(_table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard,
        op2_sharding,
        op3_pii,
        op4_html_extract,
        op5_substring_dedup,
        op6_embedding_dedup,
        op7_best_fit_packing,
        op8_mixing,
        op9_fingerprints,
        op10_toxicity,
        op11_source_divergence,
        op12_periodic_runs,
        op13_license_scan,
        pipeline,
    )
}
