"""Sharding: cuts a corpus into contiguous shards of nearly equal bytes.

Documents get one global order, by a hash of the text and then by id, so copies of a text
follow each other. Byte totals of the order's partitions give every partition the sum of
all earlier bytes; running sums inside it give every document its global offset, and equal
targets cut the offsets into shards. No task sees more than a partition's slim rows (id,
size, hashes); texts are read once and not shuffled.

A group of equal texts stays in the shard of its first byte as long as it is small next to a
shard (`together` of its target); larger groups are cut like all else.

Defined results: a null text has no bytes and the checksum of an empty one; equal rows take
neighbouring slots; an empty table gives no shards; extra columns do not matter; null ids
come first among equal texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.llm import graph
from kinseek.runtime import stage

OVERHEAD = 8  # bytes that a document costs besides its text


def shard_documents(docs: DataFrame, shards: int = 24, together: float = 0.01) -> DataFrame:
    """`doc_id, size, text_crc32, shard, slot` of every row of `docs` (doc_id, text).

    `slot` is the place in the shard, gapless from 0.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = stage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("_text"),
        )
    )
    placed = stage(graph.with_totals_before(graph.in_order(slim, ["_text", "text_crc32", "doc_id"]), _offset="size"))
    total = placed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    target = max(1.0, total / shards)
    groups = (
        placed.groupBy("_text", "text_crc32")
        .agg(F.count(F.lit(1)).alias("_copies"), F.min("_offset").alias("_first"), F.sum("size").alias("_bytes"))
        .where((F.col("_copies") > 1) & (F.col("_bytes") <= target * together))
        .select("_text", "text_crc32", "_first")
    )
    at = F.coalesce("_first", "_offset") + F.least(F.col("size"), F.lit(1)) - 1
    cut = stage(
        placed.join(groups, ["_text", "text_crc32"], "left")
        .withColumn("shard", F.least(F.floor(at / F.lit(target)), F.lit(shards - 1)).cast("int"))
        .select("doc_id", "size", "text_crc32", "shard", "_row")
    )
    first = cut.groupBy("shard").agg(F.min("_row").alias("_first"))
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_row") - F.col("_first")).alias("slot")
    )


def write_shards(docs: DataFrame, path: str, shards: int = 24) -> None:
    """Writes whole documents as Parquet, one folder `shard=K` for each shard, in slot order.

    A shard is written by as many tasks as its rows' slots ask for, so none holds a shard. Rows
    with a null id are kept; columns of `docs` called shard and slot are written as given_shard
    and given_slot.
    """
    placed = shard_documents(docs, shards).groupBy("doc_id", "size", "text_crc32").agg(F.min(F.struct("shard", "slot")).alias("_place"))
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    given = docs.select(
        F.struct(*[F.col(f"`{c}`").alias(f"given_{c}" if c in ("shard", "slot") else c) for c in docs.columns]).alias("_all"),
        F.col("doc_id").alias("_id"),
        (F.length(data) + OVERHEAD).cast("long").alias("_size"),
        F.crc32(data).alias("_crc"),
    )
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_size") == F.col("size")) & (F.col("_crc") == F.col("text_crc32"))
    (
        given.join(placed, same)
        .repartitionByRange("_place")
        .sortWithinPartitions("_place")
        .select("_all.*", "_place.shard", "_place.slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
