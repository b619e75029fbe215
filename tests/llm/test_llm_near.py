import hashlib

import numpy as np
import pytest
from conftest_llm import read, words
from kinseek.llm.embedding_dedup import near_vectors
from kinseek.llm.fingerprints import edited_fingerprints, fingerprints, likeness, near_groups
from kinseek.llm.substring_dedup import dedup_substrings, longest_repeats

VECTORS = "vec_id long, embedding array<float>, label int, weight int, shard string"


def brute_links(rows):
    """Links and components of (vec_id, vector, label) by comparing all pairs."""
    links, up = {i: 0 for i in range(len(rows))}, list(range(len(rows)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    def usable(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    for i, (_, v, k) in enumerate(rows):
        for j in range(i):
            w, m = rows[j][1:]
            if k is None or k != m or not usable(v) or not usable(w) or len(v) != len(w):
                continue
            a, b = np.array(v, np.float64), np.array(w, np.float64)
            if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    least = {}
    for i in range(len(rows)):
        least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    return sorted((rows[i][0], links[i], least[root(i)]) for i in range(len(rows)))


@pytest.mark.parametrize("shard_rows", [20_000, 60])
def test_vectors(spark, shard_rows):
    random = np.random.default_rng(1)
    rows = []
    for c in range(40):
        center = random.normal(size=24)
        for _ in range(int(random.integers(1, 12))):
            v = (center + random.normal(size=24) * 0.22).astype(np.float32).tolist()
            rows += [(len(rows), v, c % 3)]
            if random.random() < 0.2:
                rows += [(len(rows), v, c % 3)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS).repartition(4)
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in near_vectors(docs, 0.93, shard_rows).collect())
    want = brute_links(rows)
    found, there = sum(g[1] for g in got), sum(w[1] for w in want)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert 0.97 * there <= found <= there and all(g[1] <= w[1] for g, w in zip(got, want))
    assert np.mean([g == w for g, w in zip(got, want)]) > 0.95


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1),
        (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1.0, 0.0], 1), (12, [1.0, 0.0], 1), (13, [-1.0, 0.0], 1),
    ]
    got = near_vectors(spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute_links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert near_vectors(spark.createDataFrame([], VECTORS)).collect() == []


def test_a_large_group_of_near_copies(spark):
    random = np.random.default_rng(3)
    center = random.normal(size=16)
    rows = [(i, (center + random.normal(size=16) * 0.02).astype(np.float32).tolist(), 1) for i in range(700)]
    got = near_vectors(spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS)).collect()
    assert {r.component_id for r in got} == {0} and sum(r.n_links for r in got) >= 0.97 * 700 * 699


def brute_substrings(rows, window):
    first = {}
    split = {d: words(t) for d, t in rows}
    for doc, own in split.items():
        for i in range(len(own) - window + 1):
            key = tuple(own[i : i + window])
            first[key] = min(first.get(key, doc), doc)
    out = {}
    for doc, own in split.items():
        gone = {j for i in range(len(own) - window + 1) if first[tuple(own[i : i + window])] < doc for j in range(i, i + window)}
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        out[doc] = (len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("window", [2, 3, 5, 13])
def test_substrings(spark, window):
    random = np.random.default_rng(window)
    rows = []
    passage = [f"p{i}" for i in range(40)]
    for doc in range(60):
        own = [f"w{x}" for x in random.integers(0, 4 if window > 5 else 30, random.integers(0, 150))]
        if doc % 3 == 0:
            at, size = int(random.integers(0, len(own) + 1)), int(random.integers(1, 40))
            own[at:at] = passage[:size]
        rows.append((doc, " ".join(own)))
    rows += [(60 + i, rows[5][1]) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in dedup_substrings(docs, window).collect()}
    assert got == brute_substrings(rows, window)


def test_substrings_of_odd_rows(odd_docs, no_docs):
    rows = dedup_substrings(odd_docs, 13).collect()
    given = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert len(rows) == len(given)
    want = brute_substrings([g for g in given if g[0] is not None], 13)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows if r.doc_id is not None} == want
    assert [r.n_removed for r in rows if r.doc_id is None] == [0, 0]
    assert next(r for r in rows if r.doc_id == 10).kept == "tail"
    assert dedup_substrings(no_docs).collect() == []


def test_longest_repeats(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(1, f"a b {shared} c"), (2, f"{shared} d"), (3, " ".join(f"s{i}" for i in range(15))), (4, "nothing of it " * 9)]
    got = {r.doc_id: r.longest for r in longest_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 13).collect()}
    assert got == {1: 52, 2: 52, 3: 13}


def check_edited(docs):
    given = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (-r[0], r[1]))
    rows = edited_fingerprints(docs).collect()
    assert len(rows) == len(given)
    by = {r.doc_id: r for r in rows}
    for i, (doc, text) in enumerate(given):
        follow = given[(i + 1) % len(given)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + follow[:cut]
        r = by[doc]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(likeness(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(likeness(r.fingerprint, by[given[(i + 1) % len(given)][0]].fingerprint))
    return by


def test_fingerprints(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text")
    by = check_edited(docs)
    long = [r for r in by.values() if r.n_chars >= 200]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.97
    plain = {r.doc_id: r.fingerprint for r in fingerprints(docs.repartition(3)).collect()}
    assert plain == {r.doc_id: r.fingerprint for r in by.values()}


def test_fingerprints_of_odd_rows(spark, odd_docs, no_docs):
    unique = odd_docs.where("doc_id is not null and doc_id <> 12").select("doc_id", "text")
    by = check_edited(unique)
    assert by[4].fingerprint == by[5].fingerprint == "--" * 64
    check_edited(unique.where("doc_id = 1"))
    rows = edited_fingerprints(odd_docs).collect()
    assert len(rows) == odd_docs.count() and len({r.fingerprint for r in rows if r.doc_id in (1, 12)}) == 1
    assert edited_fingerprints(no_docs).collect() == []


def test_near_groups(spark, sf):
    texts = [r.text for r in read(spark, sf, "documents").collect() if len(r.text) > 1500][:60]
    edited = [t[:700] + "XY" + t[703:] for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts + edited + edited[:20])), "doc_id long, text string")
    for limit in (2048, 3):
        got = {r.node: r.component for r in near_groups(fingerprints(docs), group_rows=limit).collect()}
        assert np.mean([got.get(60 + i) == got.get(i) is not None for i in range(60)]) > 0.9
        assert all(got[120 + i] == got[60 + i] for i in range(20) if 60 + i in got)
