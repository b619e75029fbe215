"""Mixing sources to target weights by nested hash thresholds.

Every document has a hash of its id. A source takes whole passes over its documents, and
once more those whose hash lies below the source's threshold. Thresholds come from
histograms: sizes are summed by source and hash bucket, the bucket in which the running sum
meets what is left of the target is the boundary, and only that bucket is split into finer
ones, until it holds one hash. Nothing is sorted, and the documents themselves
are never shuffled: each meets its source's threshold and is kept, repeated or left out.

Thresholds are nested: a larger target keeps all documents that a smaller one takes.

Defined results: a null text has size 0; a null source is a source of its own, the last in
order; rows with equal ids are taken alike; sources without words get target 0; an empty table
gives no rows; extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinseek.llm import graph
from kinseek.runtime import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
BITS, LEVELS = 12, 5  # of each refinement; together the 60 bits of a document's hash
BROADCAST_SOURCES = 100_000  # sources broadcast to the documents; more are joined by a shuffle


def _size(text):
    """Number of runs of other characters than space and 0x09-0x0D."""
    body = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[^\x20\x09-\x0D]++", "w")
    return F.length(F.regexp_replace(body, r"[\x20\x09-\x0D]++", "")).cast("long")


def _hash60(column):
    """60 bits of the MD5 of a column's text."""
    return F.conv(F.substring(F.md5(F.coalesce(column.cast("string"), F.lit("null"))), 1, 15), 16, 10).cast("long")


def source_targets(slim: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS) -> DataFrame:
    """`_none, _name, source_size, target` of every source of `slim` (_none, _name, size).

    Sources get weights in turn by code point order. What a source would get above `most`
    times its size is dealt anew to the others by weight until none is above.
    """
    sizes = slim.groupBy("_none", "_name").agg(F.sum("size").alias("source_size"))
    ranked = graph.with_totals_before(graph.in_order(sizes, ["_none", "_name"]))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_row") % len(weights)).cast("int") + 1)
    sources = stage(ranked.withColumn("_weight", turn).select("_none", "_name", "source_size", "_weight"))
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    most_of = most * F.col("source_size")
    level, full = 0.0, -1
    while True:
        capped = F.col("_weight") * F.lit(level) >= most_of
        row = sources.agg(
            F.coalesce(F.sum(F.when(capped, most_of)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~capped, F.col("_weight"))), F.lit(0.0)).alias("weight"),
            F.coalesce(F.sum(capped.cast("int")), F.lit(0)).alias("full"),
        ).first()
        if row.full == full or row.weight == 0:
            break
        full, level = row.full, (share * total - row.held) / row.weight
    target = F.when(capped, most_of.cast("double")).otherwise(F.col("_weight") * F.lit(level))
    if row.weight == 0:
        target = F.least(most_of.cast("double"), F.lit(float("inf")))
    return sources.select("_none", "_name", "source_size", target.alias("target"))


def _thresholds(slim: DataFrame, sources: DataFrame) -> DataFrame:
    """`sources` with `_passes` (times all is taken) and `_below` (hashes below it: once more)."""
    budget = stage(
        sources.withColumn("_passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("_left", F.col("target") - F.col("_passes") * F.col("source_size"))
        .withColumn("_low", F.lit(0).cast("long"))
    )
    keys = ["_none", "_name"]
    running = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        inside = slim
        if level:
            inside = slim.withColumn("_cell", F.shiftright("_hash", shift + BITS)).join(
                _spread(budget.select(*keys, F.shiftright("_low", shift + BITS).alias("_cell")).where("_low >= 0")), [*keys, "_cell"], "left_semi"
            )
        cells = inside.groupBy(*keys, F.shiftright("_hash", shift).alias("_bucket")).agg(F.sum("size").alias("_size"))
        # At most 4,096 rows of a source meet here, whatever its number of documents.
        meets = (
            cells.withColumn("_before", F.coalesce(F.sum("_size").over(running), F.lit(0)))
            .join(budget.select(*keys, "_left"), keys)
            .where("_before <= _left and _before + _size > _left")
            .select(*keys, "_bucket", "_before", "_size")
        )
        last = level == LEVELS - 1
        low = F.shiftleft("_bucket", shift)
        if last:  # one hash is left: take it where that comes nearer to the target
            low = F.when(F.col("_left") - F.col("_before") > F.col("_before") + F.col("_size") - F.col("_left"), F.col("_bucket") + 1).otherwise(F.col("_bucket"))
        budget = stage(
            budget.join(meets, keys, "left").select(
                *keys, "source_size", "target", "_passes",
                F.when(F.col("_bucket").isNull(), F.col("_left")).otherwise(F.col("_left") - F.col("_before")).alias("_left"),
                F.coalesce(low, F.col("_low")).alias("_low"),
            )
        )
    return budget.withColumnRenamed("_low", "_below")


def _spread(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if graph.small_enough(df, BROADCAST_SOURCES) else df


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS) -> DataFrame:
    """`doc_id, size, source_size, target, taken` of every row of `docs` (doc_id, text, source)."""
    source = F.col("source").cast("string")
    slim = stage(
        docs.select(
            F.col("doc_id"),
            source.isNull().cast("int").alias("_none"),
            F.coalesce(source, F.lit("")).alias("_name"),
            _size(F.col("text")).alias("size"),
            _hash60(F.col("doc_id")).alias("_hash"),
        )
    )
    limits = _thresholds(slim, source_targets(slim, weights, share, most))
    times = F.col("_passes") + (F.col("_hash") < F.col("_below")).cast("long")
    return slim.join(_spread(limits), ["_none", "_name"]).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"), times.alias("times")
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS) -> DataFrame:
    """The rows of `docs` as often as the mix takes them; documents without words stay once.

    Documents are not joined or shuffled: a source's passes and threshold travel to them.
    """
    source = F.col("source").cast("string")
    keyed = (
        docs.withColumn("_none", source.isNull().cast("int"))
        .withColumn("_name", F.coalesce(source, F.lit("")))
        .withColumn("_hash", _hash60(F.col("doc_id")))
    )
    slim = stage(keyed.select("_none", "_name", "_hash", _size(F.col("text")).alias("size")))
    limits = _thresholds(slim, source_targets(slim, weights, share, most)).select("_none", "_name", "_passes", "_below", "source_size")
    times = F.col("_passes") + (F.col("_hash") < F.col("_below")).cast("long")
    times = F.when(F.col("source_size") == 0, 1).otherwise(times)
    met = keyed.join(_spread(limits), ["_none", "_name"]).withColumn("_times", times.cast("int"))
    return met.where("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*docs.columns)
