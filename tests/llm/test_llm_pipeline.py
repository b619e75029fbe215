import corpus_pipeline
from conftest_llm import words
from kinseek.llm.ngram_jaccard import jaccard_groups
from test_llm_pii import base
from test_llm_sharding_mixing_packing import check_packed, whole_text_ids

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == before.columns
    before, after = (d.collect() for d in seen["toxicity"])
    assert {r.doc_id for r in after} <= {r.doc_id for r in before} and len(after) >= 0.8 * len(before)
    before, after = seen["ngram_jaccard"]
    groups = {r.doc_id: r.component_id for r in jaccard_groups(before, 5, 80, 100).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(groups.values()))
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in seen["pii"])
    assert set(before) == set(after) and all((after[d] == before[d]) == (not base(before[d])) for d in before)
    assert not any(base(t) for t in after.values())
    before, after = (d.collect() for d in seen["mixing"])
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}
    size = sum(len(words(r.text)) for r in before)
    assert abs(sum(len(words(r.text)) for r in after) - 1.5 * size) < 0.2 * size
    rows = seen["packing"][1].collect()
    check_packed(rows, 4096)
    assert sum(r.length for r in rows) == sum(len(whole_text_ids(r.text)) for r in after)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    check_packed(rows, 4096)
    assert len({r.doc_id for r in rows}) > 100
    assert corpus_pipeline.ORACLE_SQL is None
