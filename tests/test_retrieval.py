import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kinseek import schemas
from kinseek.operators import bm25, fusion, lexical, ranking, rerank
from kinseek.plans.cascade import cascade, candidates, stage_counts
from samples import CHUNK_PATIENTS, QUERY, SCORES, chunk_rows


@pytest.fixture(scope="module")
def chunks(spark):
    return spark.createDataFrame(chunk_rows(), schemas.CHUNKS).cache()


def ask(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, query string")


@pytest.fixture(scope="module")
def run(spark, chunks):
    links = spark.createDataFrame(list(CHUNK_PATIENTS.items()), schemas.CHUNK_LINKS)
    return cascade(chunks, ask(spark, QUERY), links, clip=False)


def test_sample_scores(run):
    rescored = {r["chunk_id"]: r for r in run.rescored.collect()}
    final = {r["chunk_id"]: r for r in run.final.collect()}
    for chunk, (s_bm25, s_dense, fused, s_li, cross) in SCORES.items():
        row = rescored[chunk]
        got = (row["s_bm25"], row["s_dense"], row["fusion_score"], row["s_li"])
        assert got == pytest.approx((s_bm25, s_dense, fused, s_li))
        assert final[chunk]["raw_xenc_score"] == pytest.approx(cross, abs=1e-6)
        assert final[chunk]["patient_uid"] == CHUNK_PATIENTS[chunk]
    assert final["chunk_004"]["pointers"].asDict() == {"chunk_offset": 300, "file": "side_effects.txt"}


def test_sample_order(run):
    order = lambda df: [r["chunk_id"][-1] for r in df.orderBy("rank").collect()]
    assert order(run.candidates) == order(run.rescored) == list("13524")
    assert order(run.final) == list("15324")


def test_sample_evidence(run):
    row = run.rescored.where("chunk_id = 'chunk_001'").first()
    assert [(e.token, e.pos) for e in row["evidence"]] == [
        ("progression", 2), ("after", 3), ("folfirinox", 4), ("in", 10),
    ]
    assert {e.weight for e in row["evidence"]} == {0.3}


def test_clipped_scores_are_all_alike(spark, chunks):
    run = cascade(chunks, ask(spark, QUERY))
    rows = run.final.orderBy("rank").collect()
    assert {(r["raw_xenc_score"], r["calibrated_score"]) for r in rows} == {(1.0, 0.5)}
    assert [r["chunk_id"][-1] for r in rows] == list("13524")
    assert "patient_uid" not in run.final.columns


def test_empty_query_single_candidate_and_repeats(spark, chunks):
    queries = ask(spark, "", "tolerated", "folfirinox folfirinox", "absent-word", "  ")
    rows = candidates(chunks, queries).collect()
    by_query = Counter(r["query_id"] for r in rows)
    assert by_query == {1: 1, 2: 5}
    assert next(r for r in rows if r["query_id"] == 1)["fusion_score"] == 0.5
    repeated = [r for r in rows if r["query_id"] == 2]
    assert all(r["s_bm25"] == pytest.approx(0.2) and r["s_dense"] == pytest.approx(0.4) for r in repeated)
    counts = stage_counts(cascade(chunks, queries), chunks, queries).orderBy("query_id").collect()
    assert [r["final_results"] for r in counts] == [0, 1, 5, 0, 0]
    assert {r["total_chunks"] for r in counts} == {5}


def test_only_empty_queries(spark, chunks):
    assert candidates(chunks, ask(spark, "", " ")).isEmpty()
    assert bm25.bm25_top_k(chunks, ask(spark, "")).isEmpty()


def test_limits_and_depth(spark, chunks):
    queries = ask(spark, QUERY)
    run = cascade(chunks, queries, k_a=4, k_b=3, k_c=2)
    assert [df.count() for df in (run.candidates, run.rescored, run.final)] == [4, 3, 2]
    deep = rerank.rescore(run.candidates, queries, chunks, k=2, depth=4)
    assert deep.count() == 2
    short = rerank.rescore(run.candidates, queries, chunks, max_len=1)
    assert {r["s_li"] for r in short.where("chunk_id = 'chunk_001'").collect()} == {0.0}


def test_unknown_chunk_drops_out(spark, chunks):
    queries = ask(spark, QUERY)
    cands = candidates(chunks, queries)
    left = rerank.rescore(cands, queries, chunks.where("chunk_id <> 'chunk_003'"))
    assert {r["chunk_id"] for r in left.collect()} == set(SCORES) - {"chunk_003"}


def test_custom_scorer(spark, chunks):
    def by_length(pairs):
        for query, text in pairs:
            yield text.str.len().astype("float64") + 0 * query.str.len()

    run = cascade(chunks, ask(spark, QUERY), scorer=by_length)
    lengths = {r["chunk_id"]: r["raw_xenc_score"] for r in run.final.collect()}
    assert lengths == {row[0]: float(len(row[1])) for row in chunk_rows()}


def test_links_by_note_and_last_link(spark, run):
    bare = run.final.drop("patient_uid")
    links = spark.createDataFrame(
        [("note_001", "old", 1), ("note_001", "new", 2), ("note_009", "x", 3), (None, "y", 4)],
        "note_uid string, patient_uid string, ord int",
    )
    rows = rerank.attach_patients(bare, links, order="ord").collect()
    got = {r["chunk_id"]: r["patient_uid"] for r in rows}
    assert got["chunk_001"] == "new" and got["chunk_002"] is None and len(got) == 5


def test_unknown_methods(spark, chunks):
    with pytest.raises(ValueError):
        candidates(chunks, ask(spark, QUERY), method="other")
    with pytest.raises(ValueError):
        cascade(chunks, ask(spark, QUERY), calibration="other")


def test_both_spellings_of_ranked_logit_equal_the_weighted_sum(spark, chunks):
    queries = ask(spark, QUERY)
    plain = candidates(chunks, queries).collect()
    assert candidates(chunks, queries, method="ranked_logit").collect() == plain
    assert candidates(chunks, queries, method="ranked-logit").collect() == plain


def random_texts(rng, n):
    letters = "ab"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(1, 6)))
    return [" ".join(word() for _ in range(rng.randrange(0, 12))) for _ in range(n)]


@pytest.fixture(scope="module")
def random_case(spark):
    rng = random.Random(7)
    texts = random_texts(rng, 300)
    rows = [(f"c{i}", t, "s", "n", 0, "f") for i, t in enumerate(texts)]
    asked = [t for t in random_texts(rng, 12)] + ["a a ab"]
    return spark.createDataFrame(rows, schemas.CHUNKS), ask(spark, *asked), texts, asked


def brute_force(texts, asked, k, score):
    out = {}
    for q, query in enumerate(asked):
        scores = [(score(query.split(), t), f"c{i}") for i, t in enumerate(texts)]
        best = sorted((s for s in scores if s[0] > 0), key=lambda s: (-s[0], s[1]))[:k]
        out.update({(q, rank): (s, c) for rank, (s, c) in enumerate(best, 1)})
    return out


@pytest.mark.parametrize("inline_terms", [0, 1000])
def test_search_equals_brute_force(random_case, inline_terms):
    """Both ways of matching: the automaton and the column expressions."""
    chunks, queries, texts, asked = random_case
    got = lexical.search(chunks.repartition(5), queries, 7, inline_terms=inline_terms).collect()
    sides = {
        lexical.LEXICAL: lambda terms, t: sum(t.count(w) for w in terms),
        lexical.PRESENCE: lambda terms, t: sum(w in t for w in terms),
    }
    for side, score in sides.items():
        rows = {(r["query_id"], r["rank"]): (r["hits"], r["chunk_id"]) for r in got if r["side"] == side}
        assert rows == brute_force(texts, asked, 7, score)


def test_search_in_several_query_blocks(random_case, monkeypatch):
    chunks, queries, *_ = random_case
    whole = sorted(lexical.search(chunks, queries, 5).collect())
    real = lexical.blocks
    monkeypatch.setattr(lexical, "blocks", lambda q, *_, **__: real(q, max_terms=15, max_queries=3))
    assert sorted(lexical.search(chunks, queries, 5).collect()) == whole


def test_search_without_automaton(random_case, monkeypatch):
    chunks, queries, *_ = random_case
    whole = sorted(lexical.search(chunks, queries, 5).collect())
    monkeypatch.setattr(lexical, "ahocorasick", None)
    assert sorted(lexical.search(chunks, queries, 5, inline_terms=20).collect()) == whole


def test_bm25_equals_brute_force(random_case):
    chunks, queries, texts, asked = random_case
    docs = [t.split() for t in texts]
    n, average = len(docs), sum(map(len, docs)) / len(docs)
    frequency = Counter(w for d in docs for w in set(d))

    def score(terms, text):
        words = text.split()
        total = 0.0
        for w in terms:
            tf = words.count(w)
            idf = math.log(1 + (n - frequency[w] + 0.5) / (frequency[w] + 0.5))
            total += idf * tf * 1.9 / (tf + 0.9 * (0.6 + 0.4 * len(words) / average)) if tf else 0
        return round(total, 9)

    got = bm25.bm25_top_k(chunks.repartition(5), queries, 7).collect()
    rows = {(r["query_id"], r["rank"]): (r["score"], r["chunk_id"]) for r in got}
    want = brute_force(texts, asked, 7, score)
    assert rows.keys() == want.keys()
    for key in want:
        assert rows[key][1] == want[key][1] and rows[key][0] == pytest.approx(want[key][0], abs=1e-8)


def test_merging_two_lists_equals_merging_sides(random_case):
    chunks, queries, *_ = random_case
    one_scan = fusion.merge_sides(lexical.search(chunks, queries, 9))
    two = fusion.merge_lists(
        lexical.lexical_top_k(chunks, queries, 9), lexical.presence_top_k(chunks, queries, 9)
    )
    columns = sorted(two.columns)
    assert sorted(one_scan.select(columns).collect(), key=repr) == sorted(two.select(columns).collect(), key=repr)


def test_normalize_scores(spark):
    df = spark.createDataFrame(
        [(0, i, float(i)) for i in range(11)] + [(1, 1, 3.0), (1, 2, 3.0)],
        "query_id long, id long, s double",
    )
    got = {
        (r["query_id"], r["id"]): r["n"]
        for r in ranking.normalize_scores(df, "s", ["query_id"], "n", "id").collect()
    }
    assert len(got) == 13 and got[0, 3] == pytest.approx(0.3)
    assert got[1, 1] == got[1, 2] == 0.5


def test_top_k_is_the_same_however_it_is_spread(spark):
    df = spark.range(2000).select(
        (F.col("id") % 3).alias("g"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("s"), "id"
    )
    order = [F.desc("s"), F.asc("id")]
    plain = sorted(ranking.top_k(df, ["g"], order, 17).collect())
    assert sorted(ranking.top_k(df.repartition(9), ["g"], order, 17, spread=4).collect()) == plain
    assert len(plain) == 51


def test_cascade_with_other_searches(spark):
    chunks, queries = spark.createDataFrame(chunk_rows(), schemas.CHUNKS), spark.createDataFrame([(0, QUERY)], "query_id long, query string")
    plain = cascade(chunks, queries)
    same = cascade(
        chunks, queries, lexical_search=lexical.lexical_top_k, dense_search=lexical.presence_top_k, rescorer=lambda c, q, k: rerank.rescore(c, q, k=k)
    )
    keys = ["query_id", "chunk_id", "rank"]
    assert sorted(map(tuple, plain.final.select(*keys).collect())) == sorted(map(tuple, same.final.select(*keys).collect()))
    other = cascade(chunks, queries, lexical_search=bm25.bm25_top_k, k_c=2)
    assert 0 < other.final.count() <= 2
    assert other.found.select("side").distinct().count() == 2
