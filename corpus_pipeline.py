"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. What it returns is written as
Parquet and read again as the next one's docs, so a stage can be repeated by itself.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kinseek.llm.mixing import mixed_documents
from kinseek.llm.ngram_jaccard import one_of_each_group
from kinseek.llm.packing import pack_documents
from kinseek.llm.pii import sanitised
from kinseek.llm.toxicity import without_toxic
from kinseek.runtime import shared_folder

TOKENIZER = "word_bpe_49k.json"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return one_of_each_group(docs, size=5, num=80, den=100)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with placeholders for personal data and terms that disclose them."""
    return sanitised(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard", ngram_jaccard),
    ("pii", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

#: A trained classifier and a tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
