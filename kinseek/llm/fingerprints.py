"""Document fingerprints by randomised edit embedding.

A shared random walk reads a string: at every step it puts out the character it stands on
and, by a random bit that depends only on step and character, stays or goes on. After an
edit two walks of a piece drift together again. Long walks cannot run side by side, so a text is cut where its own characters
say so, an edit moves only the cuts near it, and every piece takes the walk from its start.
Which steps belong to which bit sample (band) of the walk is random and shared too; a
band's characters are hashed, and a document keeps in each of its bins the least hash of
all bands of all pieces. The share of equal bins is the likeness of two fingerprints. It follows
the set of pieces that texts share, not their edit distance: order and number of pieces are lost.

Defined results: a null text is an empty one, whose bins are all empty; two fingerprints
without a filled bin are alike (1.0); repeated rows have equal fingerprints, and follow each
other in the order of ids; a null id comes after all others in descending order; a single row is
followed by itself; an empty table gives no rows; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.llm import graph, ngram_jaccard, words

PIECE, LONGEST = 16, 32  # characters of a piece: mean and most
STEPS = 2 * LONGEST
BANDS, BINS = 2, 64
SEED = 11
BUFFERED = 1 << 20  # characters embedded at once; a longer text is embedded alone
EMPTY = np.uint64(2**64 - 1)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64(SEED))
    go = random.integers(0, 2, (STEPS, 256), dtype=np.int32)
    band = random.integers(0, BANDS, STEPS)
    return go, band, random.integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64)


def _cuts(chars: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First character of every piece of every row; rows are [offsets[i], offsets[i+1])."""
    code = chars.astype(np.uint64)
    rolled = code.copy()
    for k in range(1, 4):
        rolled[k:] += code[:-k] * np.uint64(0x9E3779B97F4A7C15 >> (3 * k))
    cut = np.zeros(len(chars) + 1, bool)
    cut[1:] = words.mix(rolled) % np.uint64(PIECE) == 0
    # The three characters before it must be of the same row.
    begin = np.repeat(offsets[:-1], np.diff(offsets))
    cut[1 : len(begin) + 1] &= np.arange(len(begin)) - begin >= 3
    cut[offsets[:-1]] = True
    cut[len(chars)] = False
    at = np.flatnonzero(cut)
    length = np.diff(np.append(at, len(chars)))
    parts = -(-length // LONGEST)
    start = np.repeat(at, parts)
    return start + LONGEST * (np.arange(len(start)) - np.repeat(np.cumsum(parts) - parts, parts))


def _walks(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """BANDS hashes of every piece: of the characters its walk puts out at the band's steps."""
    go, band, letter = _tables()
    order = np.argsort(starts - ends, kind="stable")
    at, ends = starts[order].copy(), ends[order]
    byte = (words.mix(chars.astype(np.uint64)) & np.uint64(255)).astype(np.int64)
    out = np.zeros((BANDS, len(starts)), np.uint64)
    live = np.arange(len(starts))
    here = at
    for step in range(STEPS):
        keep = here < ends[live]
        if not keep.all():
            live, here = live[keep], here[keep]
        if not len(live):
            break
        now = byte[here]
        own = out[band[step]]
        own[live] = (own[live] ^ letter[now]) * np.uint64(0x2545F4914F6CDD1D + 2 * step)
        here = here + go[step][now]
    result = np.empty_like(out)
    result[:, order] = out
    return result


def signatures(texts: list[str]) -> np.ndarray:
    """The least hash in each bin, for every text."""
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    found = np.full(len(texts) * BINS, EMPTY, np.uint64)
    full = offsets[:-1][np.diff(offsets) > 0]
    if len(full):
        starts = _cuts(chars, np.append(full, len(chars)))
        ends = np.append(starts[1:], len(chars))
        rows = np.searchsorted(offsets, starts, "right") - 1
        # Equal pieces take the same walk: it is taken once.
        power = np.arange(len(chars)) - np.repeat(starts, ends - starts)
        value = words.mix(chars.astype(np.uint64) + np.uint64(1) + (power.astype(np.uint64) << np.uint64(32)))
        _, first, number = np.unique(np.add.reduceat(value, starts), return_index=True, return_inverse=True)
        codes = _walks(chars, starts[first], ends[first])
        for k in range(BANDS):
            code = words.mix(codes[k] + np.uint64(k + 1))[number]
            np.minimum.at(found, rows * BINS + (code % np.uint64(BINS)).astype(np.int64), code >> np.uint64(8))
    return found.reshape(len(texts), BINS)


def as_text(signature: np.ndarray) -> str:
    """Two hexadecimal digits of every bin, `--` for an empty one."""
    digits = (signature >> np.uint64(8) & np.uint64(255)).astype(np.uint8).tobytes().hex()
    if not (signature == EMPTY).any():
        return digits
    return "".join("--" if s == EMPTY else digits[2 * i : 2 * i + 2] for i, s in enumerate(signature))


def _likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bins among those either has filled, by the digits that `as_text` keeps."""
    mask, no_a, no_b = np.uint64(0xFF00), a == EMPTY, b == EMPTY
    same = ((a & mask) == (b & mask)) & ~no_a & ~no_b
    filled = (~no_a | ~no_b).sum(1)
    return np.where(filled > 0, same.sum(1) / np.maximum(filled, 1), 1.0)


def likeness(a: str, b: str) -> float:
    pairs = [(a[i : i + 2], b[i : i + 2]) for i in range(0, 2 * BINS, 2)]
    filled = [(x, y) for x, y in pairs if (x, y) != ("--", "--")]
    return sum(x == y for x, y in filled) / len(filled) if filled else 1.0


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text")]
        for row in zip(*columns):
            held.append(row)
            size += len(row[3])
            if size > BUFFERED and len(held) > 1:
                yield _compared(held)
                held, size = held[-1:], len(held[-1][3])
    if held:
        yield _compared(held)


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    """A result for each row that belongs here and is followed by another of its part."""
    texts = [r[3] for r in rows]
    own = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
    edited = []
    for i in own:
        cut = len(texts[i]) // 3
        edited.append(texts[i][: len(texts[i]) - cut] + texts[i + 1][:cut])
    found = signatures(texts + edited)
    at = np.array(own, np.int64)
    mine, other, next_one = found[at], found[len(texts) :], found[at + 1]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[i][2] for i in own], pa.int64()),
            pa.array([len(texts[i]) for i in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()),
            pa.array([as_text(s) for s in mine], pa.string()),
            pa.array([as_text(s) for s in other], pa.string()),
            pa.array(_likeness(mine, other), pa.float64()),
            pa.array(_likeness(mine, next_one), pa.float64()),
        ],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """`doc_id, fingerprint` of every row of `docs` (doc_id, text)."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            ends = np.cumsum([len(t) for t in texts])
            for lo, hi in words.chunks(np.append(0, ends), BUFFERED):
                prints = [as_text(s) for s in signatures(texts[lo:hi])]
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return given.mapInArrow(own, "doc_id long, fingerprint string")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document, of an edited form of it, and how near they are.

    The edited form has the last third of the text (rounded down) replaced by as much of the
    start of the next document in descending doc_id; the first follows the last.
    Texts are shuffled once, into ranges of ids; the first document of every range goes
    to the range before it as well, so that all neighbours meet.
    """
    spark = docs.sparkSession
    # A null id sorts below all others; the id itself stays null in the result.
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    ids = docs.select(key.alias("_key"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(ids.agg(F.percentile_approx("_key", shares, 10000)).first()[0] or []))
    part = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>"), lambda b: b < F.col("_key")))
    # One row for each range, whatever the number of documents.
    heads = sorted(ids.withColumn("_part", part).groupBy("_part").agg(F.max("_key").alias("_head")).collect())
    before = {heads[i]._head: heads[(i + 1) % len(heads)]._part for i in range(len(heads))}
    guest_of = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]).cast("map<bigint,int>")
    placed = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), key.alias("_key"))
        .withColumn("_part", part)
        .withColumn("_guest", guest_of[F.col("_key")] if before else F.lit(None).cast("int"))
        .select(
            "doc_id", "text", "_key",
            F.explode(
                F.when(F.col("_guest").isNull(), F.array(F.struct(F.col("_part").alias("part"), F.lit(0).alias("guest"))))
                .otherwise(F.array(F.struct(F.col("_part").alias("part"), F.lit(0).alias("guest")), F.struct(F.col("_guest").alias("part"), F.lit(1).alias("guest"))))
            ).alias("_at"),
        )
        .select("_at.part", "_at.guest", "doc_id", "text", "_key")
    )
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        placed.repartition(count, "part")
        .sortWithinPartitions("part", "guest", F.desc("_key"), "text")
        .select("part", "guest", "doc_id", "text")
        .mapInArrow(
            _pairs,
            "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
        )
    )


def near_groups(prints: DataFrame, least: float = 0.8, rows_per_band: int = 4, group_rows: int = 2048) -> DataFrame:
    """`node`, `component` of all ids of `prints` (doc_id, fingerprint) with a near one.

    Bins are banded `rows_per_band` at a time; ids that share a band are verified by their
    whole fingerprints. Large bands are compared in pairs of blocks, and only links between ids
    not joined so far leave a task.
    """
    width = 2 * rows_per_band
    one = prints.where("doc_id is not null").dropDuplicates(["doc_id"])
    bands = one.select(
        "doc_id", "fingerprint",
        F.explode(F.array(*[F.xxhash64(F.lit(i), F.substring("fingerprint", i + 1, width)) for i in range(0, 2 * BINS, width)])).alias("token"),
    )
    sizes = bands.groupBy("token").agg(F.count(F.lit(1)).alias("_count")).where("_count > 1")
    blocks = ngram_jaccard._blocks(bands.join(sizes, "token"), "_count", "doc_id", group_rows, pairs=True)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = graph.Forest()
        for table in ngram_jaccard._groups(batches, ["token", "lo", "hi"]):
            names = [table.column(c).to_pylist() for c in ("token", "lo", "hi", "doc_id", "fingerprint")]
            groups: dict = {}
            for token, lo, hi, doc, text in zip(*names):
                groups.setdefault((token, lo, hi), {})[doc] = text
            for group in groups.values():
                members = list(group.items())
                codes = np.array([[text[i : i + 2] for i in range(0, 2 * BINS, 2)] for _, text in members])
                none = codes == "--"
                for i in range(1, len(members)):
                    filled = (~none[:i] | ~none[i]).sum(1)
                    same = ((codes[:i] == codes[i]) & ~none[:i]).sum(1)
                    for j in np.flatnonzero(same >= least * np.maximum(filled, 1)):
                        met.join(members[i][0], members[j][0])
        yield from ngram_jaccard._edges(met.pairs())

    keys = ["token", "lo", "hi"]
    return graph.components(ngram_jaccard._by_group(blocks, keys).mapInArrow(verify, "a long, b long"))
