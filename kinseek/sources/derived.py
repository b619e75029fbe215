"""Notes, chunks and queries derived from the document, embedding and label tables.

Every table is read whole and every text is used whole: a document is cut into
consecutive 20-word chunks that together hold all of its words.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinseek.functions.text import occurrences

CHUNK_WORDS = 20
QUERY_TEXTS = (
    (0, "thanedble wherthe license tionhere"),
    (1, "schkeit andthe tion"),
    (2, "the the"),
    (3, ""),
)

_T = "((doc_id * doc_id * doc_id * 31 + doc_id * 5) % 997 % 257)"
_M = "(1000 + (doc_id * doc_id * doc_id * 13 + doc_id * 7) % 1009 % 331)"

# Expressions both Spark and DuckDB accept.
NOTE_COLUMNS = {
    "ord": "doc_id",
    "uid": "concat('note_', doc_id)",
    "source_id": "CASE doc_id % 3 WHEN 0 THEN 'Source-A' WHEN 1 THEN 'Source-B' ELSE 'Source-C' END",
    "mrn": f"""CASE WHEN doc_id % 11 = 0 THEN ''
        WHEN doc_id % 2 = 0 THEN concat(CASE doc_id % 3 WHEN 0 THEN 'mda-' WHEN 1 THEN 'BMC-'
            ELSE ' CANCER-' END, {_M})
        ELSE concat('', {_M}) END""",
    "dob": f"concat('19', 50 + {_T} % 40, '-01-1', {_T} % 9)",
    "sex": f"CASE WHEN {_T} % 2 = 0 THEN 'F' ELSE 'M' END",
    "raw_text": f"""concat(text, ' ', CASE {_T} % 4 WHEN 0 THEN 'Pancreatic adenocarcinoma'
        WHEN 1 THEN 'lung carcinoma' WHEN 2 THEN 'breast' ELSE 'melanoma' END)""",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table, its rows spread over all cores where it has fewer splits than cores.

    A small file has a single row group, which one task reads; with as many splits as
    cores or more the scan is left as it is.
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# Uids repeat, and more than one note has each place in the order; every 13th uid is missing.
REPEATED_COLUMNS = {
    **NOTE_COLUMNS,
    "ord": "doc_id % 7",
    "uid": "CASE WHEN doc_id % 13 = 5 THEN NULL ELSE concat('note_', (doc_id - doc_id % 3)) END",
}


# Every fifth note has neither birth date nor sex nor diagnosis.
BARE_COLUMNS = {
    **NOTE_COLUMNS,
    "dob": f"CASE WHEN doc_id % 5 = 1 THEN NULL ELSE {NOTE_COLUMNS['dob']} END",
    "sex": f"CASE WHEN doc_id % 5 = 1 THEN NULL ELSE {NOTE_COLUMNS['sex']} END",
    "raw_text": f"CASE WHEN doc_id % 5 = 1 THEN NULL ELSE {NOTE_COLUMNS['raw_text']} END",
}

# JSON lines: an array, a broken object, a note whose unused field has another kind, and notes
# followed by something else.
LINE_SQL = """CASE doc_id % 6 WHEN 0 THEN concat('[', doc_id, ']')
    WHEN 1 THEN concat('{"uid": "note_', doc_id, '"')
    ELSE concat('{"uid": "note_', doc_id, '", "mrn": ', doc_id, ', "demographics": {"dob": "19', doc_id, '"}',
      CASE WHEN doc_id % 6 = 2 THEN ', "validation": "ok"' ELSE '' END, '}',
      CASE doc_id % 20 WHEN 3 THEN ' trailing' WHEN 9 THEN ',{"uid": "next"}' WHEN 15 THEN '} {' WHEN 16 THEN '  ' ELSE '' END) END"""


def note_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").selectExpr("doc_id", f"{LINE_SQL} AS line")


def notes(spark: SparkSession, folder: str, columns: dict[str, str] = NOTE_COLUMNS) -> DataFrame:
    flat = table(spark, folder, "documents").selectExpr(
        *[f"{sql} AS {name}" for name, sql in columns.items()]
    )
    return flat.select(
        "ord",
        "uid",
        "source_id",
        "mrn",
        F.struct("dob", "sex").alias("demographics"),
        F.struct("raw_text").alias("content"),
    )


def chunks(spark: SparkSession, folder: str) -> DataFrame:
    pieces = F.regexp_extract_all("text", F.lit(rf"(?:\S+\s*){{1,{CHUNK_WORDS}}}"), F.lit(0))
    return (
        table(spark, folder, "documents")
        .select("doc_id", "source", F.posexplode(pieces).alias("piece", "text"))
        .select(
            F.concat(F.lit("chunk_"), "doc_id", F.lit("_"), "piece").alias("chunk_id"),
            "text",
            F.col("source").alias("source_id"),
            F.concat(F.lit("note_"), "doc_id").alias("note_uid"),
            (F.col("piece") * CHUNK_WORDS).cast("long").alias("offset"),
            F.concat("source", F.lit(".txt")).alias("source_file"),
        )
    )


def text_queries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(QUERY_TEXTS, "query_id long, query string")


def benchmark_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark passage is a query."""
    return table(spark, folder, "benchmark").selectExpr("item_id AS query_id", "text AS query")


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), F.col("embedding").alias("vector")
    )


def _mean_vectors(df: DataFrame, by: list[str]) -> DataFrame:
    """The mean vector of each group."""
    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    means = df.groupBy(*by).agg(Summarizer.mean(vector).alias("mean"))
    return means.select(*by, vector_to_array("mean").alias("vector"))


def label_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """One query per label: the mean of its vectors."""
    by_label = _mean_vectors(table(spark, folder, "embeddings"), ["label"])
    return by_label.select(F.col("label").cast("long").alias("query_id"), "vector")


def label_multi_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Three vectors per label: the means of a three-way split of its vectors."""
    split = table(spark, folder, "embeddings").withColumn("query_pos", F.col("vec_id") % 3)
    return _mean_vectors(split, ["label", "query_pos"]).select(
        F.col("label").cast("long").alias("query_id"), "query_pos", "vector"
    )


def _in_tens(df: DataFrame) -> DataFrame:
    return df.withColumn("chunk_id", F.floor(F.col("vec_id") / 10).cast("long"))


def multi_vector_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Ten consecutive vectors make one multi-vector chunk."""
    return _in_tens(table(spark, folder, "embeddings")).select(
        "chunk_id", F.col("embedding").alias("vector")
    )


def mean_vector_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return _mean_vectors(_in_tens(table(spark, folder, "embeddings")), ["chunk_id"])


def scored_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Every labelled document with how often "the" occurs in it, and its quality."""
    documents = table(spark, folder, "documents").select(
        "doc_id", occurrences(F.lower("text"), "the").cast("double").alias("score")
    )
    return documents.join(table(spark, folder, "labels"), "doc_id").select(
        "doc_id", "score", F.col("quality").alias("label")
    )
