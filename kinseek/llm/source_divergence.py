"""Audit of how sources of a language differ in their words, by chunk factorization.

Texts are taken apart at white space only; the chunks of every group (a source's texts of a
language) are counted, texts of a group together, and each globally distinct chunk is tokenized
once, however often it occurs, where its counts of all groups meet. Its terms join these counts.
Occurrences add up over a term's chunks. Distinct documents do not (one document may hold `Word`,
`word,` and `word`), but a term's documents in a group lie between the greatest count of one chunk
and the sum over its chunks, and those of a language between the sums of these over its groups.
That settles nearly all terms against `least` documents; only for the terms it leaves open are
documents and chunks joined row by row.

Divergence: with count occurrences of a term in a group (a source's texts of a language, or the
whole language), p = 1 + floor(SCALE * (count + 5) / (N + 5 V)), where V is the number of kept
terms of the language and N the group's occurrences of them. Two sources differ by the sum of
their |p - q| over all kept terms; a source stands out from its language by its terms of
p > q. The sums over pairs of sources are taken in blocks of terms, a matrix of at most
`CELLS` counts each, whatever the number of sources and terms. All arithmetic is exact.

Defined results: null text, language and source count as empty strings; every (language, source)
that occurs is there, without terms too; documents are rows, ids are not read; ties go by the
UTF-8 order of the item; an empty table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinseek.llm import graph
from kinseek.llm.words import buffers
from kinseek.runtime import arrow_batches, stage

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
# Fixed value: bytes of a text with A-Z lower-cased and a space for every other one that no term holds.
PLAIN = np.array([b if b > 0x7F or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)], np.uint8)
LEAST = 30  # documents of a language that a kept term occurs in
TOP = 50
SCALE = 1_000_000_000
SHORT = (1 << 63) // SCALE - 6  # counts below it times SCALE fit a long
CELLS = 1 << 16  # counts (terms x sources) that one task compares at once
BROADCAST_BYTES = 16 << 20  # of chunks and terms that a scan looks up; a shuffle join beyond it
BROADCAST_ROWS = 100_000  # languages, or their sources, that a join broadcasts
BATCH_BYTES = 16 << 20  # of texts that an executor hands to a Python worker at once


def _given(docs: DataFrame) -> DataFrame:
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    return docs.select(plain("lang"), plain("source"), F.make_valid_utf8(plain("text")).alias("text"))


def _split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The document and the code of each chunk of `texts`, and the distinct chunks by code."""
    pieces = pc.ascii_split_whitespace(texts)
    codes = pieces.flatten().dictionary_encode()
    at, code = pc.list_parent_indices(pieces).to_numpy().astype(np.int64), codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # White space at either end of a text leaves an empty chunk there.
    filled = pc.greater(pc.binary_length(codes.dictionary), 0).to_numpy(zero_copy_only=False)[code] if len(code) else slice(0)
    return at[filled], code[filled], codes.dictionary


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    return np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)


def _held(group: np.ndarray, at: np.ndarray, code: np.ndarray, size: int, rows: int) -> tuple[np.ndarray, ...]:
    """Group, chunk and document of every document's distinct chunks, in this order, and occurrences.

    Last, the places where a group's next chunk begins.
    """
    key = np.sort((group[at] * size + code) * rows + at)
    pairs = _starts(key)
    own, at = np.divmod(key[pairs], max(rows, 1))
    group, code = np.divmod(own, max(size, 1))
    return group, code, at, np.diff(np.append(pairs, len(key))), _starts(own)


def _count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`chunk, gid, n, docs` of each batch: occurrences in a group and documents that hold them."""
    for batch in batches:
        at, code, chunks = _split(batch.column("text"))
        groups, group = np.unique(batch.column("gid").to_numpy(), return_inverse=True)
        group, code, at, times, first = _held(group, at, code, len(chunks), batch.num_rows)
        n = np.add.reduceat(times, first) if len(first) else times
        docs = np.diff(np.append(first, len(at)))
        yield pa.RecordBatch.from_arrays([chunks.take(pa.array(code[first])), pa.array(groups[group[first]]), pa.array(n), pa.array(docs)], ["chunk", "gid", "n", "docs"])


def _terms(chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """For each chunk and distinct term of it: place of the chunk, code of the term, times; and the terms."""
    data, offsets = buffers(chunks)
    at, code, terms = _split(pa.StringArray.from_buffers(len(chunks), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(PLAIN[data])))
    key = np.sort(at * max(len(terms), 1) + code)
    first = _starts(key)
    at, code = np.divmod(key[first], max(len(terms), 1))
    return at, code, np.diff(np.append(first, len(key))), terms


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`gid, chunk, term, count, docs` from counts in the order of chunk and group; a chunk is tokenized once."""
    names = ["chunk", "gid", "n", "docs"]
    kept = None  # rows of the last chunk so far, at most one per group; the next batch may go on with it

    def spelled(chunks: pa.Array, place: np.ndarray, gid: np.ndarray, n: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
        at, code, times, terms = _terms(chunks)
        begin = np.searchsorted(at, place)
        size = np.searchsorted(at, place, "right") - begin
        row = np.repeat(np.arange(len(place)), size)
        pick = begin[row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        out = [pa.array(gid[row]), chunks.take(pa.array(place[row])), terms.take(pa.array(code[pick])), pa.array(n[row] * times[pick]), pa.array(docs[row])]
        return pa.RecordBatch.from_arrays(out, ["gid", "chunk", "term", "count", "docs"])

    for batch in batches:
        rows = pa.Table.from_batches([batch.select(names)]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch.select(names)])])
        if not len(rows):
            continue
        codes = rows["chunk"].combine_chunks().dictionary_encode()
        place, gid = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64), rows["gid"].to_numpy()
        first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (gid[1:] != gid[:-1])))
        n, docs = (np.add.reduceat(rows[c].to_numpy(), first) for c in ("n", "docs"))
        place, gid = place[first], gid[first]
        done = np.searchsorted(place, place[-1])
        kept = pa.table([codes.dictionary.take(pa.array(place[done:])), pa.array(gid[done:]), pa.array(n[done:]), pa.array(docs[done:])], schema=rows.schema)
        if done:
            yield spelled(codes.dictionary.slice(0, len(codes.dictionary) - 1), place[:done], gid[:done], n[:done], docs[:done])
    if kept is not None:
        gid, n, docs = (kept[c].to_numpy() for c in names[1:])
        yield spelled(kept["chunk"].combine_chunks().slice(0, 1), np.zeros(len(kept), np.int64), gid, n, docs)


def _spelled(given: DataFrame, groups: DataFrame) -> DataFrame:
    """`gid, chunk, term, count, docs` of every group's chunks: occurrences of the term, documents of the chunk."""
    # Texts of a group lie together, so that a task meets few groups and most chunks of them many times.
    numbered = given.withColumn("_row", F.monotonically_increasing_id())  # the same if a task runs again
    dealt = _with(numbered, groups, ["lang", "source"]).repartitionByRange("gid", "_row").select("gid", "text")
    counts = dealt.mapInArrow(_count_chunks, "chunk string, gid long, n long, docs long")
    together = counts.repartition("chunk").sortWithinPartitions("chunk", "gid")
    with arrow_batches(given.sparkSession, BATCH_BYTES):
        return stage(together.mapInArrow(_spell, "gid long, chunk string, term string, count long, docs long"))


def _fits(df: DataFrame) -> bool:
    """Whether all bytes of a table of strings are few enough to broadcast."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= BROADCAST_BYTES


def _looked_up(df: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """Join with a table of strings, by broadcast if it is small."""
    return df.join(F.broadcast(per_key) if _fits(per_key) else per_key, keys)


def _find_chunks(wanted: pa.Array | None, least: int):
    """`lang, _row, chunk` of documents' distinct chunks, of those in `wanted` if given.

    Chunks that `least` documents of a batch and language hold are left out there.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, code, chunks = _split(batch.column("text"))
            if wanted is not None:
                found = pc.is_in(chunks, value_set=wanted).to_numpy(zero_copy_only=False)[code] if len(code) else slice(0)
                at, code = at[found], code[found]
            lang = batch.column("lang").dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            _, code, at, _, first = _held(lang, at, code, len(chunks), batch.num_rows)
            docs = np.diff(np.append(first, len(at)))
            rare = np.repeat(docs < least, docs)
            at = pa.array(at[rare])
            yield pa.RecordBatch.from_arrays([batch.column("lang").take(at), batch.column("_row").take(at), chunks.take(pa.array(code[rare]))], ["lang", "_row", "chunk"])

    return find


def _documents(given: DataFrame, open_: DataFrame, least: int) -> DataFrame:
    """`lang, term, docs`: exact numbers of documents of the terms in `open_` (lang, chunk, term).

    A chunk that `least` documents hold settles its terms, so that none in `open_` is one.
    """
    # A number of the row, the same if a task runs again; given before its chunks become rows.
    numbered = given.select("lang", F.monotonically_increasing_id().alias("_row"), "text")
    names = open_.select("chunk").distinct()
    wanted = pa.array([r.chunk for r in names.collect()], pa.string()) if _fits(names) else None
    met = _looked_up(numbered.mapInArrow(_find_chunks(wanted, least), "lang string, _row long, chunk string"), open_, ["lang", "chunk"])
    return met.select("lang", "term", "_row").distinct().groupBy("lang", "term").agg(F.count(F.lit(1)).alias("docs"))


def _kept_terms(given: DataFrame, groups: DataFrame, spelled: DataFrame, counts: DataFrame, least: int) -> DataFrame:
    """`lang, term, lang_count` of all terms that `least` documents of `lang` hold."""
    # A document has one source, so that the bounds of the sources add up.
    bounds = _with(counts, groups, ["gid"]).groupBy("lang", "term").agg(
        F.sum("low").alias("low"), F.sum("high").alias("high"), F.sum("count").alias("lang_count")
    )
    verdict = stage(bounds.where(F.col("high") >= least).select("lang", "term", "lang_count", (F.col("low") >= least).alias("sure")))
    unsure = verdict.where("not sure").select("lang", "term")
    met = _looked_up(_with(spelled.select("gid", "chunk", "term"), groups, ["gid"]), unsure, ["lang", "term"])
    open_ = stage(met.select("lang", "chunk", "term").distinct())
    counted = _documents(given, open_, least).where(F.col("docs") >= least).select("lang", "term")
    with arrow_batches(given.sparkSession, BATCH_BYTES):
        return stage(verdict.where("sure").drop("sure").union(verdict.where("not sure").drop("sure").join(counted, ["lang", "term"])))


def term_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """All groups (`lang, source, total, terms`), and `lang, source, term, count, lang_count` of kept terms that occur."""
    given = _given(docs)
    groups = stage(given.select("lang", "source").distinct().withColumn("gid", F.monotonically_increasing_id()))
    spelled = _spelled(given, groups)
    counts = stage(spelled.groupBy("gid", "term").agg(F.sum("count").alias("count"), F.max("docs").alias("low"), F.sum("docs").alias("high")))
    kept = _kept_terms(given, groups, spelled, counts, least)
    uses = _looked_up(_with(counts.select("gid", "term", "count"), groups, ["gid"]), kept, ["lang", "term"])
    uses = stage(uses.select("lang", "source", "term", "count", "lang_count"))
    totals = uses.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    groups = groups.select("lang", "source").join(totals, ["lang", "source"], "left").join(terms, "lang", "left").na.fill(0, ["total", "terms"])
    return stage(groups), uses


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 5) / (total + 5 * terms)), exact at any count."""
    above = (count + 5).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    exact = F.call_function("div", above, (total + 5 * terms).cast("decimal(20,0)"))
    short = F.call_function("div", (count + 5).cast("long") * F.lit(SCALE).cast("long"), (total + 5 * terms).cast("long"))
    return F.when(count < SHORT, short).otherwise(exact) + 1


def _with(df: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """Join with a table of one row per key, by broadcast if it is small."""
    return df.join(F.broadcast(per_key) if graph.small_enough(per_key, BROADCAST_ROWS) else per_key, keys)


def _differences(counts: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """Sums of |p - q| over the terms of a block, for the tile's sources against all others."""
    names = sources.sort_values("source", kind="stable")
    place = pd.Index(names["source"])
    rows, terms = pd.factorize(counts["term"]) if len(counts) else ([], [])
    shares = np.tile(names["zero"].to_numpy(np.int64), (len(terms), 1))
    shares[rows, place.get_indexer(counts["source"])] = counts["share"].to_numpy(np.int64)
    found = []
    for at in np.flatnonzero(names["mine"].to_numpy(bool)):
        value = np.abs(shares - shares[:, at : at + 1]).sum(0)
        found.append(pd.DataFrame({"source": place[at], "item": place, "value": value}).drop(index=at))
    out = pd.concat(found) if found else pd.DataFrame({"source": [], "item": [], "value": []})
    return out.assign(lang=names["lang"].iloc[0])[["lang", "source", "item", "value"]] if len(names) else out.assign(lang="")


def source_pairs(shares: DataFrame, groups: DataFrame, languages: DataFrame) -> DataFrame:
    """`lang, source, item, value` of every ordered pair of sources of a language."""
    plan = languages.select(
        "lang",
        F.greatest(F.ceil(F.col("terms") * F.col("sources") / CELLS), F.lit(1)).alias("_blocks"),
        F.ceil(F.col("sources") * F.col("sources") / CELLS).alias("_tiles"),
    )
    tile = F.pmod(F.xxhash64("source"), F.col("_tiles"))
    counts = _with(shares, plan, ["lang"]).select(
        "lang", "source", "term", "share", F.pmod(F.xxhash64("term"), F.col("_blocks")).alias("_block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tiles") - 1)).alias("_tile"),
    )
    sources = (
        _with(groups, plan, ["lang"])
        .select("lang", "source", "zero", tile.alias("_own"), "_blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tiles") - 1)).alias("_tile"))
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("_block"))
        .select("lang", "source", "zero", (F.col("_own") == F.col("_tile")).alias("mine"), "_block", "_tile")
    )
    keys = ["lang", "_block", "_tile"]
    parts = counts.groupBy(*keys).cogroup(sources.groupBy(*keys)).applyInPandas(
        _differences, "lang string, source string, item string, value long"
    )
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """`lang, source, part, item, value, rank` of every (language, source) of `docs`.

    Part `pair` has all other sources of the language, part `term` the `top` terms that the
    source has more often than its language has.
    """
    groups, uses = term_counts(docs, least)
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.sum("total").alias("lang_total"), F.max("terms").alias("terms"))
    languages = stage(sizes)
    zero = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(0)
    groups = stage(_with(groups.drop("terms"), languages, ["lang"]).select("lang", "source", "total", "terms", "lang_total", zero.alias("zero")))
    shares = _with(uses, groups.drop("zero"), ["lang", "source"]).withColumn("share", _share(F.col("count"), F.col("total"), F.col("terms")))
    pairs = source_pairs(shares.select("lang", "source", "term", "share"), groups.select("lang", "source", "zero"), languages)
    above = F.col("share") - _share(F.col("lang_count"), F.col("lang_total"), F.col("terms"))
    own = shares.select("lang", "source", F.col("term").alias("item"), above.alias("value")).where("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return (
        pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
        .unionByName(ranked.withColumn("part", F.lit("term")))
        .select("lang", "source", "part", "item", "value", "rank")
    )
