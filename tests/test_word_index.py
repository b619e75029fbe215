import random

import numpy as np
import pytest

from kinseek import runtime, schemas
from kinseek.operators import bm25, lexical, word_index
from kinseek.operators.word_index import BM25, LEXICAL, PRESENCE, build_index, load_index, search_index

SEARCH = {BM25: bm25.bm25_top_k, LEXICAL: lexical.lexical_top_k, PRESENCE: lexical.presence_top_k}


def ask(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, query string")


def rows(df):
    return sorted((r.query_id, r["rank"], r.chunk_id, round(r.score, 9), r.source_id, r.note_uid) for r in df.collect())


@pytest.fixture(scope="module")
def corpus(spark):
    """Words of very different frequency, null, empty and long texts, and texts that tie."""
    rng = random.Random(11)
    stems = [a + b for a in ("ab", "aba", "ca", "x", "rare") for b in ("", "a", "ba", "zz")]
    texts = []
    for i in range(700):
        words = [stems[int(len(stems) * rng.random() ** 3)] for _ in range(rng.randrange(0, 14))]
        texts.append("  ".join(w.upper() if rng.random() < 0.2 else w for w in words))
    texts += [None, "", " \t ", "ab " * 3000, "ab ca", "ab ca", "ca ab"]
    made = [(f"c{i:04}", t, f"s{i % 5}" if i % 9 else None, f"n{i % 31}", i, "f") for i, t in enumerate(texts)]
    return spark.createDataFrame(made, schemas.CHUNKS).repartition(5).cache()


QUERIES = ("ab ca", "rarezz x", "AB ab ab rare", "missing", "", " ", "b", "zz a", "xba caba abaa abzz ca a")


@pytest.mark.parametrize("kind", [BM25, LEXICAL, PRESENCE])
@pytest.mark.parametrize("k", [1, 7, 1000])
def test_index_equals_scan(spark, corpus, kind, k):
    index = build_index(corpus, segment_rows=23)
    queries = ask(spark, *QUERIES)
    assert rows(search_index(index, queries, kind, k)) == rows(SEARCH[kind](corpus, queries, k))


def test_many_short_queries(spark, corpus):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["ab", "aba", "ca", "x", "rarezz", "zz", "b"]) for _ in range(rng.randint(1, 3))) for _ in range(3000)]
    index, queries = build_index(corpus, segment_rows=100), ask(spark, *texts)
    assert rows(search_index(index, queries, BM25, 3)) == rows(bm25.bm25_top_k(corpus, queries, 3))


@pytest.mark.parametrize("kind", [BM25, LEXICAL])
def test_segments_that_cannot_reach_the_floor_are_left_out(spark, kind):
    """Chunks with many of the asked words lie together; the other segments have few."""
    texts = [("needle " * 5 if 300 <= i < 340 else "needle " if i % 10 == 0 else "") + f"hay straw h{i}" for i in range(1000)]
    made = [(f"c{i:04}", t, "s", "n", i, "f") for i, t in enumerate(texts)]
    chunks = spark.createDataFrame(made, schemas.CHUNKS).coalesce(1)
    queries, waves = ask(spark, "needle", "needle straw"), []
    index = build_index(chunks, segment_rows=20)
    assert rows(search_index(index, queries, kind, 10, waves=waves)) == rows(SEARCH[kind](chunks, queries, 10))
    passed = {(r.query_id, r.wave): r["count"] for r in waves[0].groupBy("query_id", "wave").count().collect()}
    assert passed[0, 0] >= 45 and passed[0, 0] + passed[0, 1] + passed.get((0, 2), 0) == 50
    assert passed[1, 0] >= 45


def test_blocks_that_cannot_reach_the_floor_are_left_out():
    weights = word_index.TermWeights.build([(0, 0, 2.0), (1, 0, 1.0), (1, 1, 1.0)], 2, 2)
    row, term = np.array([0, 64, 65, 130, 131]), np.array([0, 1, 0, 1, 1])
    value = np.array([3.0, 1.0, 1.5, 0.5, 2.0])
    alive = word_index._alive(weights, row, term, value, 2, np.array([4.0, 1.5]))
    assert alive.tolist() == [[True, False], [True, False], [False, True]]


@pytest.mark.parametrize("kind", [BM25, LEXICAL, PRESENCE])
def test_a_task_hands_on_only_what_is_best_so_far(spark, kind):
    """All chunks tie: 50 segments of which each has `k` chunks that reach the floor."""
    made = [(f"c{(i * 7) % 1000:04}", "hay straw", "s", "n", i, "f") for i in range(1000)]
    chunks, queries = spark.createDataFrame(made, schemas.CHUNKS).coalesce(1), ask(spark, "hay")
    index = build_index(chunks, segment_rows=20)
    handed, _ = word_index._block_top_k(index, [(0, ["hay"])], kind, 5, 0.9, 0.4)
    assert handed.count() < 150  # 250 if each segment hands on its own best
    assert rows(search_index(index, queries, kind, 5)) == rows(SEARCH[kind](chunks, queries, 5))


def test_best_so_far():
    best = word_index._BestSoFar(2, 2)
    ids = np.array(["c", "a", None, "b"], object)
    assert best.new(np.array([0, 0, 1, 0]), np.array([1.0, 2.0, 1.0, 1.0]), ids).tolist() == [0, 1, 2, 3]
    assert best.floor.tolist() == [1.0, -np.inf] and best.last[0] == "b"
    assert best.new(np.array([0, 0, 1]), np.array([1.0, 1.0, 0.5]), np.array(["bb", "b", "z"], object)).tolist() == [1, 2]
    assert best.new(np.array([0, 1]), np.array([0.5, 3.0]), np.array(["a", "y"], object)).tolist() == [1]
    assert best.floor.tolist() == [1.0, 1.0] and best.last.tolist() == ["b", ""]
    assert best.new(np.zeros(0, int), np.zeros(0), np.zeros(0, object)).tolist() == []


def test_ties_of_the_last_place_go_by_id():
    ids = np.array(["d", "b", "c", "a"], object)
    row, query, score = np.array([0, 1, 2, 3, 0]), np.array([0, 0, 0, 0, 1]), np.array([1.0, 2.0, 1.0, 1.0, 5.0])
    best = word_index._best_cells(row, query, score, ids, 2)
    assert sorted((int(query[i]), ids[row[i]]) for i in best) == [(0, "a"), (0, "b"), (1, "d")]


def test_kept_index(spark, corpus, tmp_path):
    index = build_index(corpus, carry=("source_id",), segment_rows=64)
    index.write(str(tmp_path / "index"))
    kept = load_index(spark, str(tmp_path / "index"))
    assert kept.carry == ("source_id",) and kept.statistics() == index.statistics()
    queries = ask(spark, *QUERIES)
    one, other = (search_index(i, queries, LEXICAL, 9).drop("note_uid") for i in (index, kept))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))
    # A search for few words reads the postings of those words only.
    plan = kept.postings.where("word in ('ab', 'ca')")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(word), In(word" in plan.replace("\n", "")


def test_empty_tables(spark, corpus):
    none = build_index(corpus.where("false"))
    index = build_index(corpus)
    for kind in (BM25, LEXICAL, PRESENCE):
        assert search_index(none, ask(spark, "ab"), kind).collect() == []
        assert search_index(index, ask(spark, "", " "), kind).collect() == []
        assert search_index(index, ask(spark, "ab").where("false"), kind).collect() == []
    with pytest.raises(ValueError, match="unknown score"):
        search_index(index, ask(spark, "ab"), "other")


def test_terms_are_found_without_an_automaton(spark, corpus, monkeypatch):
    index = build_index(corpus, segment_rows=50)
    want = sorted(map(tuple, word_index.vocabulary(index, ["ab", "zz", "b"], False).collect()))
    monkeypatch.setattr(word_index, "ahocorasick", None)
    got = word_index._parts_of_words(["ab", "zz", "b"])
    words = word_index.pa.RecordBatch.from_pydict({"word": sorted({r.word for r in index.postings.select("word").distinct().collect()})})
    assert sorted(tuple(r.values()) for b in got([words]) for r in b.to_pylist()) == [(w, list(t), list(n)) for w, t, n in want]


def test_a_search_for_parts_writes_no_row_per_word(spark):
    """Every word occurs once: what is written for an index and a search does not have 6000 rows."""
    texts = [" ".join(f"w{i}x{j}" for j in range(20)) for i in range(300)]
    made = [(f"c{i:04}", t, "s", "n", i, "f") for i, t in enumerate(texts)]
    chunks, queries = spark.createDataFrame(made, schemas.CHUNKS).coalesce(1), ask(spark, "w1 x1", "x19 9x w")
    before = len(runtime._staged(spark))
    index = build_index(chunks, segment_rows=50)
    assert rows(search_index(index, queries, LEXICAL, 5)) == rows(lexical.lexical_top_k(chunks, queries, 5))
    written = [spark.read.parquet(path).count() for path in runtime._staged(spark)[before:]]
    assert len(written) > 3 and max(written) < 100


@pytest.mark.parametrize("kind", [BM25, LEXICAL, PRESENCE])
def test_all_white_space_and_letters_of_any_width(spark, kind):
    spaces = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000"
    texts = [f"{c}ab{c}{c}ca{i % 3}{c}" for i, c in enumerate(spaces)]
    texts += ["aaaa AAA aa", "abababa aba", "\u0130x \u03a3\u0391\u03a3", "\U0001f600ab ab\U0001f600\U0001f600", "ab\u200bca \u180e", "\ufeffab"]
    made = [(f"c{i:03}", t, "s", "n", i, "f") for i, t in enumerate(texts)]
    chunks = spark.createDataFrame(made, schemas.CHUNKS).repartition(2)
    queries = ask(spark, "ab", "ca1 aa aba", "\U0001f600 i \u03c3", "\u200b \u180e \ufeffab", "aaa a")
    assert rows(search_index(build_index(chunks, segment_rows=4), queries, kind, 9)) == rows(SEARCH[kind](chunks, queries, 9))


def test_terms_that_overlap_count_as_in_the_scan(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("aab") for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    terms = ["a", "aa", "aba", "abab", "b", "bb", "aaaa", "zz"]
    monkeypatch.setattr(word_index, "MATCHED_WORDS", 70)
    sizes, held, times = word_index._matcher(terms)(words)
    want = [[(i, w.count(t)) for i, t in enumerate(terms) if t in w] for w in words]
    assert sizes.tolist() == [len(x) for x in want]
    assert list(zip(held.tolist(), times.tolist())) == [x for found in want for x in found]
    assert [len(x) for x in word_index._matcher(terms)([])] == [0, 0, 0]


@pytest.mark.parametrize("limit", ["VOLUME_ROWS", "VOLUME_WORDS"])
def test_tasks_of_several_volumes(spark, corpus, monkeypatch, tmp_path, limit):
    monkeypatch.setattr(word_index, limit, 60)
    index, queries = build_index(corpus, segment_rows=20), ask(spark, *QUERIES)
    assert index.volumes.count() > 10
    assert index.segments.select("segment").distinct().count() == index.segments.count()
    index.write(str(tmp_path / "index"))
    for made in (index, load_index(spark, str(tmp_path / "index"))):
        for kind in (BM25, LEXICAL, PRESENCE):
            assert rows(search_index(made, queries, kind, 7)) == rows(SEARCH[kind](corpus, queries, 7))
