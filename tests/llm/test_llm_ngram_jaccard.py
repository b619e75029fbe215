import random
from collections import Counter

import numpy as np
import pytest
from conftest_llm import FOLD, words
from kinseek.llm import graph
from kinseek.llm.ngram_jaccard import Threshold, jaccard_groups, one_of_each_group, trie_links


def brute(rows, size, num, den):
    sets, up = {}, {}
    for doc, text in rows:
        own = words((text or "").translate(FOLD))
        found = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if len(own) >= size else ({tuple(own)} if own else set())
        if doc is not None:
            sets[doc], up[doc] = found, doc

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    holders = {}
    for doc, found in sets.items():
        for s in found:
            holders.setdefault(s, []).append(doc)
    for a, found in sets.items():
        shared = Counter(b for s in found for b in holders[s] if b < a)
        for b, c in shared.items():
            if den * c >= num * (len(found) + len(sets[b]) - c) and root(a) != root(b):
                up[max(root(a), root(b))] = min(root(a), root(b))
    return {d: (len(s), root(d)) for d, s in sets.items()}


def near_copies(seed, count):
    """Groups whose members change a few words each, so that chains of links form."""
    rng, rows = random.Random(seed), []
    vocabulary = [f"v{i}" for i in range(60)]
    for _ in range(count):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 9)):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(own)))
            base = own if rng.random() < 0.5 else base
    return rows


def test_sets_of_many_parts(spark):
    """Sets around the sizes at which the number of parts changes, near the threshold."""
    rng, rows = random.Random(8), []
    for size in (470, 512, 530, 600, 1020, 1030, 1200, 2100):
        base = [f"v{rng.randrange(4000)}" for _ in range(size)]
        for _ in range(7):
            own = list(base)
            for _ in range(rng.randint(size // 200, size // 35)):
                own[rng.randrange(len(own))] = f"u{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(own[: len(own) - rng.randint(0, size // 12)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_groups(docs, 4, 85, 100).collect()}
    want = brute(rows, 4, 85, 100)
    assert got == want
    assert 5 < sum(c != d for d, (_, c) in want.items()) < 48


@pytest.mark.parametrize("limits", [{}, {"group_rows": 3, "block_shingles": 300}])
def test_near_copies(spark, limits):
    rows = near_copies(5, 40)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_groups(docs, 4, 85, 100, **limits).collect()}
    want = brute(rows, 4, 85, 100)
    assert got == want
    assert sum(c != d for d, (_, c) in want.items()) > 20


def test_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = jaccard_groups(odd_docs, 4, 85, 100).collect()
    assert len(got) == len(rows)
    want = brute(rows, 4, 85, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert want[2][1] == want[12][1] == 1 and want[8][1] == 7 and want[16][1] == 15 and want[10][1] == 9
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]


def test_repeated_ids_with_different_texts(spark):
    """An id has the links of all its texts, so it can join what its texts alone do not."""
    rows = near_copies(12, 60)
    rng = random.Random(2)
    rows = [(rng.randrange(len(rows) // 2), text) for _, text in rows] + [(3, None), (3, ""), (3, rows[0][1]), (3, rows[0][1])]
    up = {d: d for d, _ in rows}

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    alone = brute(list(enumerate(t for _, t in rows)), 4, 85, 100)
    for i, (_, j) in alone.items():
        a, b = root(rows[i][0]), root(rows[j][0])
        up[max(a, b)] = min(a, b)
    want = sorted((d, alone[i][0], root(d)) for i, (d, _) in enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, jaccard_groups(docs, 4, 85, 100).collect())) == want
    assert len({r.doc_id for r in one_of_each_group(docs, 4, 85, 100).collect()}) == len({r for _, _, r in want})


def test_empty_table(no_docs):
    assert jaccard_groups(no_docs).collect() == []
    assert one_of_each_group(no_docs).collect() == []


def test_one_of_each_group(odd_docs):
    kept = one_of_each_group(odd_docs, 5, 80, 100)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 9, 11, 14, 15]
    assert sum(r.doc_id is None for r in kept.collect()) == 2


@pytest.mark.parametrize("cross", [False, True])
def test_trie_finds_all_links(cross):
    random_ = np.random.default_rng(4)
    limit = Threshold(4, 80, 100)
    base = random_.choice(400, 60, replace=False)
    sets = []
    for _ in range(60):
        own = set(base.tolist())
        for _ in range(int(random_.integers(0, 12))):
            own.discard(int(random_.choice(base)))
            own.add(int(random_.integers(400, 900)))
        sets.append(np.array(sorted(own), np.uint64))
    items = [(i, i, s) for i, s in enumerate(sets)]
    met, want = graph.Forest(), graph.Forest()
    half = items[:30] if cross else items
    trie_links(half, items[30:] if cross else None, limit, met)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both) and (not cross or (i >= 30 > j)):
                want.join(i, j)
    assert [met.root(i) for i in range(60)] == [want.root(i) for i in range(60)]


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 502), (7, 7)] + [(1000, k) for k in range(1001, 1400)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and got[502] == 500 and got[1399] == 1000
