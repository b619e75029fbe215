import numpy as np
import pytest
from pyspark.sql import functions as F

from kinseek.operators import calibrate, dense


@pytest.fixture(scope="module")
def case(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 16))
    vectors = centres[rng.integers(0, 5, 400)] + 0.3 * rng.normal(size=(400, 16))
    vectors[7] = vectors[3]
    queries = centres + 0.1 * rng.normal(size=(5, 16))
    frame = lambda m, key: spark.createDataFrame(
        [(i, [float(x) for x in row]) for i, row in enumerate(m)], f"{key} long, vector array<float>"
    )
    return frame(vectors, "chunk_id").repartition(5), frame(queries, "query_id"), vectors, queries


def cosines(vectors, queries):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    return unit(queries.astype(np.float32).astype(float)) @ unit(vectors.astype(np.float32).astype(float)).T


def ranked(df):
    rows = {}
    for r in df.orderBy("query_id", "rank").collect():
        rows.setdefault(r["query_id"], []).append(r["chunk_id"])
    return rows


def test_cosine_equals_brute_force(case):
    v, q, vectors, queries = case
    exact = np.round(cosines(vectors, queries), 6)
    got = ranked(dense.cosine_top_k(v, q, 10))
    for i, row in enumerate(exact):
        assert got[i] == sorted(range(len(row)), key=lambda j: (-row[j], j))[:10]


def test_cosine_in_several_query_blocks(case, monkeypatch):
    v, q, *_ = case
    whole = ranked(dense.cosine_top_k(v, q, 10))
    monkeypatch.setattr(dense, "BLOCK_VALUES", 32)
    assert ranked(dense.cosine_top_k(v, q, 10)) == whole


def test_missing_vectors_are_left_out(spark, case):
    v, q, *_ = case
    bare = spark.createDataFrame([(999, None)], v.schema)
    assert ranked(dense.cosine_top_k(v.unionByName(bare), q, 10)) == ranked(dense.cosine_top_k(v, q, 10))


def test_lsh_recall(case):
    v, q, *_ = case
    exact, near = ranked(dense.cosine_top_k(v, q, 10)), ranked(dense.lsh_top_k(v, q, 10, oversample=4))
    recall = np.mean([len(set(exact[i]) & set(near.get(i, []))) / 10 for i in exact])
    assert recall >= 0.9
    everything = ranked(dense.lsh_top_k(v, q, 10, oversample=40))
    assert everything == exact


def test_lsh_recall_where_no_vector_is_near(spark):
    """Directions without structure, the hardest case: 7.5 % of the pairs are compared."""
    rng = np.random.default_rng(8)
    frame = lambda m, key: spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(m)], f"{key} long, vector array<double>")
    v, q = frame(rng.normal(size=(2000, 64)), "chunk_id"), frame(rng.normal(size=(8, 64)), "query_id")
    exact, near = ranked(dense.cosine_top_k(v, q, 50)), ranked(dense.lsh_top_k(v, q, 50))
    assert np.mean([len(set(exact[i]) & set(near[i])) / 50 for i in exact]) >= 0.9
    assert dense.OVERSAMPLE * 50 < 0.1 * 2000


def test_sketches_count_the_planes_between_vectors(case):
    v, q, vectors, queries = case
    planes = dense.sign_planes(128, 16)
    side = lambda m: m.astype(np.float32).astype(float) @ planes.T > 0
    agree = (side(queries)[:, None] == side(vectors)[None]).sum(2)
    got = dense.sketch_top_k(dense.sign_sketches(v, 16, 128), q, 5, 128).collect()
    assert len(got) == 25
    for i, row in enumerate(agree):
        want = sorted(range(len(row)), key=lambda j: (-row[j], j))[:5]
        assert [(r["chunk_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == i] == [(j, row[j]) for j in want]


def test_kept_sketches_and_query_blocks(case, monkeypatch):
    v, q, *_ = case
    whole = ranked(dense.lsh_top_k(v, q, 10))
    assert ranked(dense.lsh_top_k(v, q, 10, sketches=dense.sign_sketches(v, 16).cache())) == whole
    monkeypatch.setattr(dense, "BLOCK_VALUES", 32)
    assert ranked(dense.lsh_top_k(v.repartition(3), q, 10)) == whole


def test_sketches_of_odd_vectors(spark):
    nan = float("nan")
    made = [("a", [1.0, 0.0]), ("b", None), ("c", [0.0, 0.0]), ("d", [nan, 1.0]), ("e", [None, 1.0]), ("f", [1.0, 0.1]), ("g", [1.0, 0.0])]
    vectors = spark.createDataFrame(made, "chunk_id string, vector array<double>")
    asked = spark.createDataFrame([(0, [2.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0])], "query_id long, vector array<double>")
    got = dense.lsh_top_k(vectors, asked, 9).orderBy("rank").collect()
    assert [(r["query_id"], r["chunk_id"]) for r in got] == [(0, "a"), (0, "g"), (0, "f")]
    assert dense.lsh_top_k(vectors.where("false"), asked, 9).collect() == []
    assert dense.lsh_top_k(vectors, asked.where("false"), 9).collect() == []
    with pytest.raises(ValueError, match="64"):
        dense.sign_sketches(vectors, 2, 100)
    with pytest.raises(Exception, match="must have 3 elements"):
        dense.lsh_top_k(vectors, spark.createDataFrame([(0, [1.0, 0.0, 0.0])], "query_id long, vector array<double>"), 3).collect()


def test_maxsim(spark):
    rng = np.random.default_rng(4)
    chunks, asked = rng.normal(size=(6, 5, 4)), rng.normal(size=(2, 3, 4))
    v = spark.createDataFrame(
        [(f"c{c}", [float(x) for x in row]) for c in range(6) for row in chunks[c]],
        "chunk_id string, vector array<double>",
    )
    q = spark.createDataFrame(
        [(i, p, [float(x) for x in asked[i][p]]) for i in range(2) for p in range(3)],
        "query_id long, query_pos long, vector array<double>",
    )
    cands = spark.createDataFrame(
        [(i, f"c{c}", c + 1) for i in range(2) for c in range(6) if (i, c) != (0, 2)],
        "query_id long, chunk_id string, rank int",
    )
    got = {
        (r["query_id"], r["chunk_id"]): r["s_maxsim"]
        for r in dense.maxsim_rescore(cands, v, q, 6).collect()
    }
    assert len(got) == 11
    for (i, c), score in got.items():
        want = (asked[i] @ chunks[int(c[1:])].T).max(axis=1).sum()
        assert score == pytest.approx(want, abs=1e-6)


@pytest.fixture(scope="module")
def labels(spark):
    rng = np.random.default_rng(5)
    score = np.round(rng.normal(size=500), 1)
    label = (rng.random(500) < 1 / (1 + np.exp(-(0.4 + 1.3 * score)))).astype(int)
    rows = [(float(s), int(y)) for s, y in zip(score, label)]
    return spark.createDataFrame(rows, "score double, label int"), score, label


def calibrated(labels, method):
    df = labels.withColumnRenamed("score", "raw").withColumn("query_id", F.lit(0))
    return {r["raw"]: r["out"] for r in calibrate.calibrate(df, method, labels, "raw", "out").collect()}


def test_isotonic_is_monotone_and_optimal(labels):
    frame, score, label = labels
    got = calibrated(frame, "isotonic")
    levels = sorted(got)
    fitted = [got[s] for s in levels]
    assert all(a <= b + 1e-12 for a, b in zip(fitted, fitted[1:]))
    sums = np.array([label[score == s].sum() for s in levels], dtype=float)
    sizes = np.array([(score == s).sum() for s in levels], dtype=float)
    for i in range(len(levels)):
        mean = lambda a, b: sums[a : b + 1].sum() / sizes[a : b + 1].sum()
        want = max(min(mean(a, b) for b in range(i, len(levels))) for a in range(i + 1))
        assert fitted[i] == pytest.approx(want, abs=1e-9)


def test_platt_equals_newton(labels):
    frame, score, label = labels
    x, w = np.column_stack([np.ones_like(score), score]), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (label - p))
    got = calibrated(frame, "platt")
    for s, value in got.items():
        assert value == pytest.approx(1 / (1 + np.exp(-(w[0] + w[1] * s))), abs=1e-5)
    assert all(0 <= v <= 1 for v in got.values())


def test_methods_without_labels_are_min_max(labels):
    frame = labels[0].withColumn("query_id", F.lit(0))
    plain = calibrate.calibrate(frame, "minmax", score="score", out="o").collect()
    for method in ("isotonic", "platt"):
        assert calibrate.calibrate(frame, method, score="score", out="o").collect() == plain
    values = [r["o"] for r in plain]
    assert min(values) == 0 and max(values) == 1
    with pytest.raises(ValueError):
        calibrate.calibrate(frame, "beta", score="score")


def test_best_rows_over_many_blocks():
    import pyarrow as pa

    from kinseek.operators.score_blocks import BestRows

    rng = np.random.default_rng(6)
    scores = rng.integers(0, 6, size=(30_000, 7)).astype(float)
    names = [f"c{i}" for i in rng.permutation(30_000)]
    best = BestRows(np.arange(7) * 10, 9, positive=True)
    for at in range(0, 30_000, 500):
        rows = pa.RecordBatch.from_arrays([pa.array(names[at : at + 500])], ["chunk_id"])
        best.add(rows, scores[at : at + 500])
    got = [tuple(r.values()) for b in best.batches(pa.float64(), {}) for r in b.to_pylist()]
    want = [
        (names[i], q * 10, scores[i, q])
        for q in range(7)
        for i in sorted(range(30_000), key=lambda i: (-scores[i, q], names[i]))[:9]
    ]
    assert sorted(got) == sorted(want)


def test_vectors_of_another_width_raise(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0, 0.0, 1.0]), ("c", [1.0, 2.0, 3.0])], "chunk_id string, vector array<double>")
    asked = spark.createDataFrame([(0, [1.0, 0.0, 0.0])], "query_id long, vector array<double>")
    with pytest.raises(Exception, match="must have 3 elements"):
        dense.cosine_top_k(vectors, asked, 3).collect()


def test_vectors_that_are_no_numbers_take_no_place(spark):
    nan = float("nan")
    rows = [(f"c{i:02}", [1.0, i / 10]) for i in range(8)] + [(f"n{i}", [nan, 1.0]) for i in range(6)] + [("z", [None, 1.0])]
    asked = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, vector array<double>")
    for k in (4, 20):
        got = dense.cosine_top_k(spark.createDataFrame(rows, "chunk_id string, vector array<double>").coalesce(1), asked, k).orderBy("rank").collect()
        assert [r["chunk_id"] for r in got] == [f"c{i:02}" for i in range(min(k, 8))]
