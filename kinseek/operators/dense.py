"""Vector search: exact cosine, sign sketches with exact re-ranking, and MaxSim re-scoring."""

from __future__ import annotations

from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.fixed_values import K_A
from kinseek.functions.text import dot
from kinseek.operators.query_batch import small_or_plain
from kinseek.operators.ranking import SPREAD, top_k
from kinseek.operators.score_blocks import BestRows, queries_per_block, rows_per_block
from kinseek.runtime import stage

BLOCK_VALUES = 16_000_000
VECTOR_DIGITS = 6
SKETCH_BITS = 1024
OVERSAMPLE = 3  # candidates of a sketch search for each row wanted
PLANE_MODULUS = 1_000_003
PLANE_FACTORS = (48_271, 16_807)


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a column of vectors, which must all have `width` elements; null ones are NaN."""
    sizes = pc.list_value_length(column)
    if len(sizes) and pc.any(pc.not_equal(sizes, width)).as_py():
        raise ValueError(f"vectors must have {width} elements, as the queries' do")
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(len(column), width)


def _cosines(query_ids: np.ndarray, query_matrix: np.ndarray, k: int, digits: int):
    def run(batches):
        best = BestRows(query_ids, k, positive=False)
        step = rows_per_block(len(query_ids))
        unit_queries = _unit(query_matrix)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                vectors = _matrix(part.column("vector"), query_matrix.shape[1])
                scores = np.round(_unit(vectors) @ unit_queries.T, digits)
                scores[~np.isfinite(vectors).all(1)] = np.nan
                best.add(part.select(["chunk_id"]), scores)
        yield from best.batches(pa.float64(), {})

    return run


def cosine_top_k(
    vectors: DataFrame, query_vectors: DataFrame, k: int = K_A, digits: int = VECTOR_DIGITS
) -> DataFrame:
    """Exact top `k` by cosine, of (chunk_id, vector) for (query_id, vector).

    Query vectors go to the tasks in blocks of bounded size, one pass over the vectors
    each. A task multiplies whole Arrow batches and passes on its best rows per query
    only. Scores are rounded before ranking so that equal vectors tie; ties go by id. A
    vector with a null or non-finite element has no score; one of another length raises.
    """
    vectors = vectors.where(F.col("vector").isNotNull())
    query_vectors = stage(
        query_vectors.where(F.col("vector").isNotNull()).select("query_id", "vector")
    )
    width = query_vectors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    parts = max(
        1, ceil(width[0] * (width[1] or 1) / BLOCK_VALUES), ceil(width[0] / queries_per_block(k))
    )
    kind = vectors.schema["chunk_id"].dataType.simpleString()
    found = []
    for part in range(parts):
        chosen = F.pmod(F.xxhash64("query_id"), F.lit(parts)) == part
        rows = (query_vectors.where(chosen) if parts > 1 else query_vectors).collect()
        if rows:
            ids = np.array([row["query_id"] for row in rows], dtype=np.int64)
            matrix = np.array([row["vector"] for row in rows], dtype=np.float64)
            scored = vectors.select("chunk_id", "vector").mapInArrow(
                _cosines(ids, matrix, k, digits),
                f"chunk_id {kind}, query_id long, score double",
            )
            found.append(scored)
    if not found:
        found.append(
            vectors.where("false").selectExpr("chunk_id", "0L AS query_id", "0D AS score")
        )
    order = [F.desc("score"), F.asc("chunk_id")]
    return top_k(
        reduce(DataFrame.unionByName, found), ["query_id"], order, k, spread=SPREAD
    )


def sign_planes(bits: int, width: int) -> np.ndarray:
    """`bits` hyperplanes of whole numbers by a fixed rule, so that any engine can repeat them."""
    n = np.arange(1, bits * width + 1, dtype=np.int64).reshape(bits, width)
    cube = n * n % PLANE_MODULUS * n % PLANE_MODULUS
    spread = (cube * PLANE_FACTORS[0] + n * PLANE_FACTORS[1]) % PLANE_MODULUS
    return (spread - PLANE_MODULUS // 2).astype(np.float64)


def _sketch(matrix: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """A row of 64-bit words per vector: on which side of each plane it lies."""
    with np.errstate(invalid="ignore"):
        bits = matrix @ planes.T > 0
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _directed(matrix: np.ndarray) -> np.ndarray:
    """Which rows have a direction: only finite elements, and not all of them 0."""
    return np.isfinite(matrix).all(1) & (np.nan_to_num(matrix) != 0).any(1)


def sign_sketches(vectors: DataFrame, width: int, bits: int = SKETCH_BITS) -> DataFrame:
    """`chunk_id, sketch`: one bit for each of `bits` hyperplanes, for vectors with a direction.

    A kept table of sketches serves any number of searches; it holds `bits` / 8 bytes a vector.
    """
    if bits <= 0 or bits % 64:
        raise ValueError("a sketch has a multiple of 64 bits")
    kind = vectors.schema["chunk_id"].dataType.simpleString()

    def run(batches):
        planes = sign_planes(bits, width)
        for batch in batches:
            matrix = _matrix(batch.column("vector"), width)
            kept = np.flatnonzero(_directed(matrix))
            words = _sketch(matrix[kept], planes)
            offsets = np.arange(len(kept) + 1, dtype=np.int32) * (bits // 8)
            sketches = pa.Array.from_buffers(
                pa.binary(), len(kept), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(words))]
            )
            ids = batch.column("chunk_id").take(pa.array(kept))
            yield pa.RecordBatch.from_arrays([ids, sketches], ["chunk_id", "sketch"])

    present = vectors.where(F.col("vector").isNotNull()).select("chunk_id", "vector")
    return present.mapInArrow(run, f"chunk_id {kind}, sketch binary")


def _agreeing_bits(query_ids: np.ndarray, asked: np.ndarray, k: int):
    """The `k` sketches of every query that agree with its own in most bits."""
    size = 8 * asked.shape[1]

    def run(batches):
        best = BestRows(query_ids, k, positive=False)
        step = rows_per_block(len(query_ids) * asked.shape[1])
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                column = part.column("sketch")
                begin = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
                words = np.frombuffer(column.buffers()[2], np.uint64, part.num_rows * size // 8, int(begin))
                other = words.reshape(part.num_rows, 1, -1) ^ asked
                agree = 8 * size - np.bitwise_count(other).sum(2, dtype=np.int64)
                best.add(part.select(["chunk_id"]), agree.astype(np.float64))
        yield from best.batches(pa.float64(), {})

    return run


def sketch_top_k(sketches: DataFrame, query_vectors: DataFrame, k: int, bits: int = SKETCH_BITS) -> DataFrame:
    """`query_id, chunk_id, score, rank`: the `k` sketches that agree in most bits; ties go by id."""
    asked = stage(query_vectors.where(F.col("vector").isNotNull()).select("query_id", "vector"))
    count, width = asked.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    kind = sketches.schema["chunk_id"].dataType.simpleString()
    parts = max(1, ceil(count * max(width or 1, bits // 64) / BLOCK_VALUES), ceil(count / queries_per_block(k)))
    found = []
    for part in range(parts):
        rows = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(parts)) == part).collect()
        matrix = np.array([[np.nan if x is None else x for x in r["vector"]] for r in rows], np.float64).reshape(len(rows), width or 1)
        kept = np.flatnonzero(_directed(matrix))
        if len(kept):
            ids = np.array([r["query_id"] for r in rows], np.int64)[kept]
            run = _agreeing_bits(ids, _sketch(matrix[kept], sign_planes(bits, width)), k)
            found.append(sketches.mapInArrow(run, f"chunk_id {kind}, query_id long, score double"))
    if not found:
        found.append(sketches.where("false").selectExpr("chunk_id", "0L AS query_id", "0D AS score"))
    order = [F.desc("score"), F.asc("chunk_id")]
    return top_k(reduce(DataFrame.unionByName, found), ["query_id"], order, k, spread=SPREAD)


def _pair_cosines(digits: int):
    def run(batches):
        for batch in batches:
            width = max([len(v) for v in batch.column("asked").slice(0, 1).to_pylist()], default=0)
            left, right = _unit(_matrix(batch.column("asked"), width)), _unit(_matrix(batch.column("vector"), width))
            score = np.round(np.einsum("ij,ij->i", left, right), digits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id"), batch.column("chunk_id"), pa.array(score)], ["query_id", "chunk_id", "score"]
            )

    return run


def lsh_top_k(
    vectors: DataFrame,
    query_vectors: DataFrame,
    k: int = K_A,
    oversample: int = OVERSAMPLE,
    bits: int = SKETCH_BITS,
    digits: int = VECTOR_DIGITS,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """Approximate top `k` by cosine: exact among the `oversample` * `k` nearest sign sketches.

    The share of hyperplanes that separate two vectors grows with their angle, so sketches
    that agree in many bits belong to near vectors. One scan of the sketches (128 bytes a
    vector, whatever its length) keeps each task's best rows per query; only those
    candidates' vectors are fetched and compared. No vector is shuffled to find them, and
    no bucket can grow hot. `sketches` may be a kept table of `sign_sketches`.

    A vector without a direction (null, no finite numbers, all 0) is neither found nor
    a query. Ties of bits and of scores go by id; one id stands for one vector.
    """
    if oversample < 1:
        raise ValueError("oversample must be at least 1")
    asked = stage(query_vectors.where(F.col("vector").isNotNull()).select("query_id", F.col("vector").cast("array<double>").alias("vector")))
    width = asked.agg(F.max(F.size("vector"))).first()[0] or 1
    if sketches is None:
        sketches = sign_sketches(vectors, width, bits)
    near = stage(sketch_top_k(sketches, asked, k * oversample, bits).select("query_id", "chunk_id"))
    fetched = vectors.select("chunk_id", F.col("vector").cast("array<double>").alias("vector")).join(small_or_plain(near), "chunk_id")
    pairs = fetched.join(small_or_plain(asked.withColumnRenamed("vector", "asked")), "query_id").select("query_id", "chunk_id", "asked", "vector")
    kind = vectors.schema["chunk_id"].dataType.simpleString()
    scored = pairs.mapInArrow(_pair_cosines(digits), f"query_id long, chunk_id {kind}, score double")
    return top_k(scored, ["query_id"], [F.desc("score"), F.asc("chunk_id")], k, spread=SPREAD)


def maxsim_rescore(
    candidates: DataFrame, chunk_vectors: DataFrame, query_vectors: DataFrame, k: int
) -> DataFrame:
    """Late interaction on vectors: for each query vector the best dot product among the
    chunk's vectors, summed over the query's vectors.

    `chunk_vectors` (chunk_id, vector) and `query_vectors` (query_id, query_pos, vector)
    hold several rows per id. A chunk's vectors are never gathered: each is compared with
    its queries' vectors and the maxima are combined map-side, so a chunk with very many
    vectors is spread over tasks like any other rows. Ties keep the candidates' order.
    """
    wanted = stage(candidates.select("query_id", "chunk_id", F.col("rank").alias("_before")))
    asked = query_vectors.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("query_pos", "vector"))).alias("asked")
    )
    rows = chunk_vectors.select("chunk_id", "vector").join(small_or_plain(wanted), "chunk_id")
    dots = F.transform("asked", lambda a: dot(a["vector"], F.col("vector")))
    best = (
        rows.join(asked, "query_id")
        .select("query_id", "chunk_id", "_before", F.posexplode(dots).alias("at", "dot"))
        .groupBy("query_id", "chunk_id", "_before", "at")
        .agg(F.max("dot").alias("best"))
    )
    scored = best.groupBy("query_id", "chunk_id", "_before").agg(
        F.round(F.sum("best"), VECTOR_DIGITS).alias("s_maxsim")
    )
    order = [F.desc("s_maxsim"), F.asc("_before")]
    return top_k(scored, ["query_id"], order, k).drop("_before")
