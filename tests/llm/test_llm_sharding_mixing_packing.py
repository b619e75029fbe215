import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from conftest_llm import read, words
from kinseek.llm.mixing import mix_sources, mixed_documents
from kinseek.llm import packing
from kinseek.llm.words import buffers
from kinseek.llm.packing import pack_documents, plan_patterns, token_pieces
from kinseek.llm.sharding import shard_documents, write_shards
from tokenizers import Tokenizer

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def check_shards(docs, shards):
    rows = shard_documents(docs, shards).collect()
    given = docs.collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in given)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    target, largest = sum(sizes.values()) / shards, max(r.size for r in rows)
    assert all(abs(sizes[k] - target) <= largest + 0.02 * target for k in range(shards))
    return rows


def test_shards_of_the_table(spark, sf):
    docs = read(spark, sf, "documents")
    rows = check_shards(docs, 7)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, shard_documents(docs.repartition(3), 7).collect()))


def test_shards_of_odd_rows(odd_docs, no_docs):
    rows = check_shards(odd_docs, 3)
    assert next(r for r in rows if r.doc_id == 5)[1:3] == (8, 0)
    assert shard_documents(no_docs).collect() == []


def test_small_groups_of_copies_stay_together(spark):
    rng = random.Random(2)
    rows = [(i, f"copy {i // 3}") if i < 90 else (i, "y" * rng.randint(50, 900)) for i in range(900)]
    got = shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    homes = defaultdict(set)
    for r in got:
        if r.doc_id < 90:
            homes[r.doc_id // 3].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())


def test_a_large_group_of_copies_is_cut(spark):
    rows = [(i, "the same text") for i in range(400)] + [(i, f"text {i} of its own") for i in range(400, 500)]
    check_shards(spark.createDataFrame(rows, "doc_id long, text string"), 10)


def test_written_shards(spark, sf, tmp_path):
    docs = read(spark, sf, "documents")
    write_shards(docs, str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.collect()) == sorted(r.doc_id for r in docs.collect())
    want = {r.doc_id: r.shard for r in shard_documents(docs, 5).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == want


def test_written_shards_of_odd_rows(spark, odd_docs, tmp_path):
    docs = odd_docs.selectExpr("*", "'s' as shard", "'t' as slot", "1 as size", "2 as _all")
    write_shards(docs, str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.columns) == sorted([*odd_docs.columns, "given_shard", "given_slot", "size", "_all", "shard", "slot"])
    assert Counter((r.doc_id, r.text, r.given_shard, r.given_slot) for r in back.collect()) == Counter((r.doc_id, r.text, "s", "t") for r in odd_docs.collect())


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Fills sources by weight, fixing those that reach their cap."""
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    full = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[n] for n in full)
        rest = sum(weight[n] for n in names if n not in full)
        out = {n: most * sizes[n] if n in full else weight[n] * left / rest for n in names}
        more = {n for n in names if n not in full and out[n] >= most * sizes[n]}
        if not more:
            return out
        full |= more


def test_mix(spark, sf):
    docs = read(spark, sf, "documents")
    rows = mix_sources(docs).collect()
    given = {r.doc_id: (len(words(r.text)), r.source) for r in docs.collect()}
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        size, source = given[r.doc_id]
        assert r.size == size and r.taken in (0, size, 2 * size)
        sizes[source] += size
        taken[source] += r.taken
        largest[source] = max(largest[source], size)
    want = targets(dict(sizes))
    for r in rows:
        source = given[r.doc_id][1]
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    again = mix_sources(docs.repartition(4)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    copies = Counter(r.doc_id for r in mixed_documents(docs).collect())
    assert all(copies[r.doc_id] == r.taken // r.size for r in rows if r.size)


def test_mix_is_nested(spark, sf):
    docs = read(spark, sf, "documents")
    less = {r.doc_id: r.taken for r in mix_sources(docs, weights=(1,), share=0.4).collect()}
    more = {r.doc_id: r.taken for r in mix_sources(docs, weights=(1,), share=0.7).collect()}
    assert all(less[d] <= more[d] for d in less) and sum(less.values()) < sum(more.values())


def test_mix_of_odd_rows(odd_docs, no_docs):
    rows = mix_sources(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.taken <= 2 * r.size for r in rows)
    assert next(r for r in rows if r.doc_id == 5).size == 0
    assert mixed_documents(odd_docs).columns == odd_docs.columns
    assert mix_sources(no_docs).collect() == [] and mixed_documents(no_docs).collect() == []


def whole_text_ids(text):
    return [*Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids, 1]


ODD_TEXTS = [
    "It's we'LL they'd  A1b2 c d ́e é İstanbul ΣΑΣ ...!?\t\r\n\x0b\x0c\x1c\x1d\x85z",
    "<|endoftext|> x<|startoftext|>y 12 345,67 \U0001f600\U0001f468‍\U0001f469",
    "",
    "''''s 't'tt 're",
]


def test_ids_are_those_of_the_whole_text(spark, sf):
    texts = [r.text for r in read(spark, sf, "documents").limit(60).collect()] + ODD_TEXTS
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = defaultdict(bytes)
    for r in sorted(token_pieces(docs, TOKENIZER, 50, keep_ids=True).collect(), key=lambda r: (r.doc_id, r.piece)):
        assert r.start * 4 == len(got[r.doc_id]) and r.ids_crc32 == zlib.crc32(r.ids) and r.length <= 50
        got[r.doc_id] += bytes(r.ids)
    for doc, text in enumerate(texts):
        assert np.frombuffer(got[doc], "<u4").tolist() == whole_text_ids(text), text[:60]


def test_ids_of_random_texts(monkeypatch):
    rng = random.Random(2)
    signs = ["'s", "'S", "'re", "'", "a", "B", "Ve", "1", "22", ".", ",", "-", "é", "É", "e\u0301", "İ", "ß", " ", "\n", "\x1c", "\x85", "\U0001f600", "中", "½", "\x01", "<|endoftext|>", "ſ"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    for cached in (10**6, 50):
        monkeypatch.setattr(packing, "CACHED_WORDS", cached)
        words = packing._Words(TOKENIZER)
        for at in range(0, len(texts), 500):
            part = texts[at : at + 500]
            ids, begin = words.ids(*buffers(pa.array([t.encode() for t in part], pa.binary())))
            want = Tokenizer.from_file(TOKENIZER).encode_batch(part, add_special_tokens=False)
            assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == [w.ids for w in want]


class _Counted:
    def __init__(self, model):
        self.model, self.seen = model, []

    def tokenize(self, part):
        self.seen.append(part)
        return self.model.tokenize(part)


def test_parts_that_words_share_are_coded_once():
    words = packing._Words(TOKENIZER)
    words.model = _Counted(words.model)
    for text in ("\u00c9tude, Alpha's beta", "alpha. (BETA) \u00e9tude \u00c9TUDE's", "alpha 'beta'"):
        ids, _ = words.ids(*buffers(pa.array([text.encode()], pa.binary())))
        assert ids.tolist() == whole_text_ids(text)[:-1]
    # The model is given bytes as letters, of which the tokenizer's have two for each of \u00e9.
    assert len(words.model.seen) == len(set(words.model.seen)) == 9
    assert {"alpha", "beta", "'s", ",", ".", "(", ")", "'"} >= {p for p in words.model.seen if "tude" not in p}


def test_new_words_take_little_memory():
    """Peak memory of Python and NumPy over a batch in which every word is new."""
    texts = [" ".join(f"w{chr(97 + n % 26)}x{n * 64 + k:x}" for k in range(64)) for n in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array([t.encode() for t in texts], pa.binary())], ["doc_id", "text"])
    size = batch.column("text").nbytes
    for _ in packing._pieces(TOKENIZER, 64, 1, False)(iter([batch.slice(0, 1)])):
        pass  # loads the tokenizer
    tracemalloc.start()
    try:
        for _ in packing._pieces(TOKENIZER, 64, 1, False)(iter([batch])):
            pass
        assert tracemalloc.get_traced_memory()[1] < 36 * size
    finally:
        tracemalloc.stop()


def check_packed(rows, capacity):
    used = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(used), sum(r.length for r in rows)


def test_packing(spark, sf):
    docs = read(spark, sf, "documents")
    rows = pack_documents(docs, TOKENIZER).collect()
    count, total = check_packed(rows, 4096)
    assert count <= -(-total // 4096) + 2
    assert len({r.doc_id for r in rows}) == docs.count()


def test_packing_of_odd_rows(odd_docs, no_docs):
    rows = pack_documents(odd_docs, TOKENIZER, capacity=64).collect()
    check_packed(rows, 64)
    firsts = Counter(r.doc_id for r in rows if r.piece == 0)
    assert firsts == Counter(r.doc_id for r in odd_docs.collect())
    assert [r.length for r in rows if r.doc_id == 5] == [1]
    assert pack_documents(no_docs, TOKENIZER).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plans_take_every_piece(seed):
    rng = random.Random(seed)
    histogram = Counter(rng.choice([rng.randint(1, 64), rng.randint(1, 20), 33]) for _ in range(rng.randint(1, 3000)))
    plan = plan_patterns(dict(histogram), 64)
    taken = Counter()
    for p in plan:
        assert sum(p.lengths) <= 64 and p.times > 0
        for k in p.lengths:
            taken[k] += p.times
    assert taken == histogram
    bound = max(-(-sum(k * v for k, v in histogram.items()) // 64), sum(v for k, v in histogram.items() if k > 32))
    assert sum(p.times for p in plan) <= bound * 1.05 + 1


def test_completion_beats_best_fit():
    # Best fit puts 6 beside 4 and wastes; completion finds 5 + 5, 6 + 2 + 2, 4 + 4 + 2.
    assert sum(p.times for p in plan_patterns({5: 2, 6: 1, 4: 2, 2: 3}, 10)) == 3


def test_many_short_pieces_fit_one_sequence():
    plan = plan_patterns({1: 2000}, 4096)
    assert [(Counter(p.lengths), p.times) for p in plan] == [(Counter({1: 2000}), 1)]


def test_many_empty_texts(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "if(id % 2 = 0, '', null) as text")
    rows = pack_documents(docs, TOKENIZER, capacity=4096).collect()
    assert check_packed(rows, 4096) == (1, 2000) and len(rows) == 2000


@pytest.mark.parametrize(
    "lengths, capacity",
    [
        ((10, 23, 36, 40, 41, 44, 50, 51), 100),
        ((28, 32, 34, 50, 71, 84, 84, 101, 103), 200),
        ((40, 56, 58, 70, 75, 85, 86, 94, 98, 120), 200),
    ],
)
def test_plans_meet_the_bound(lengths, capacity):
    # The fillings that waste least around the largest length need one sequence more.
    assert sum(p.times for p in plan_patterns(Counter(lengths), capacity)) == -(-sum(lengths) // capacity)


def test_packing_hands_out_small_batches(spark, monkeypatch):
    """A Python worker gets a few MB of texts at a time, however many rows a batch may have."""
    rows = [(i, "ab cd " * 20_000) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, sizes = spark.conf.get(key), []

    def staged(df):
        own = docs.select("text").mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["size"]) for b in batches), "size long")
        sizes.extend(r.size for r in own.collect())
        return packing_stage(df)

    packing_stage = packing.stage
    monkeypatch.setattr(packing, "stage", staged)
    assert packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).count() >= 60
    assert sum(sizes) > 60 * 120_000 > packing.BATCH_BYTES and max(sizes) < packing.BATCH_BYTES + 200_000
    assert spark.conf.get(key) == before


def test_word_table_stays_small():
    """Texts of ever new words do not make the table grow past its bound and one group of texts."""
    words = packing._Words(public_tokenizers.path("word_bpe_49k.json"))
    for k in range(12):
        text = " ".join(f"w{i}" for i in range(k * 30_000, (k + 1) * 30_000)).encode()
        words.ids(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert len(words.hashes) < 240_000 and words.flat.nbytes < 8 << 20
