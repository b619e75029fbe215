import random

import pytest
from pyspark.sql import functions as F

from kinseek import schemas
from kinseek.operators import hot_keys, linking, matching, records
from kinseek.plans.identity import resolve
from kinseek.sources import readers
from kinseek.plans.report import report_summary
from samples import NOTES

KEYED = (
    "ord long, note_uid string, mrn string, source_id string, dob string, sex string, "
    "diagnoses array<string>, mrn_key string, triplet string"
)


def keyed_frame(spark, keys):
    rows = [
        (i, f"n{i}", m, "S", None, None, [], m, t) for i, (m, t) in enumerate(keys)
    ]
    return spark.createDataFrame(rows, KEYED)


def one_by_one(keys):
    """Rule and founder's position per note, deciding notes in order."""
    by_mrn, by_triplet, out = {}, {}, []
    for i, (m, t) in enumerate(keys):
        if m in by_mrn:
            out.append(("mrn_match", by_mrn[m]))
        elif t in by_triplet:
            out.append(("triplet_match", by_triplet[t]))
        else:
            out.append(("new_patient", i))
            if m:
                by_mrn[m] = i
            if t:
                by_triplet[t] = i
    return out


def linked_rules(linked):
    rows = {r["ord"]: (r["rule"], r["patient_uid"]) for r in linked.collect()}
    return [rows[i] for i in sorted(rows)]


def check_against_scan(spark, keys, **options):
    got = linked_rules(linking.link_notes(keyed_frame(spark, keys), **options))
    want = one_by_one(keys)
    assert [r for r, _ in got] == [r for r, _ in want]
    assert [u for _, u in got] == [got[founder][1] for _, founder in want]


def random_keys(rng, n, n_mrn, n_triplet):
    mrn = lambda: "" if rng.random() < 0.15 else f"m{rng.randrange(n_mrn)}"
    return [(mrn(), f"t{rng.randrange(n_triplet)}") for _ in range(n)]


@pytest.mark.parametrize("seed,n,n_mrn,n_triplet", [(1, 12, 3, 3), (2, 60, 20, 15), (3, 600, 150, 120)])
def test_links_equal_a_sequential_scan(spark, seed, n, n_mrn, n_triplet):
    check_against_scan(spark, random_keys(random.Random(seed), n, n_mrn, n_triplet))


@pytest.mark.parametrize("chain_after", [1, 3])
def test_chains_equal_a_sequential_scan(spark, chain_after):
    check_against_scan(
        spark, random_keys(random.Random(4), 300, 60, 60), chain_after=chain_after
    )


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    chain = []
    for i in range(150):
        chain += [(f"m{i:03}", f"t{i:03}"), (f"m{i + 1:03}", f"t{i:03}")]
    rounds = []
    real = matching._without_keys_of
    monkeypatch.setattr(
        matching, "_without_keys_of", lambda *a: rounds.append(1) or real(*a)
    )
    check_against_scan(spark, chain, chain_after=2)
    assert len(rounds) <= 4


def test_hot_keys_are_spread_without_changing_links(spark, monkeypatch):
    monkeypatch.setattr(hot_keys, "FLOOR", 10)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    rng = random.Random(5)
    keys = random_keys(rng, 300, 40, 40)
    keys += [("hot" if rng.random() < 0.5 else f"m{rng.randrange(40)}", "||") for _ in range(250)]
    rng.shuffle(keys)
    spread = []
    real = hot_keys.find_hot_keys
    for module in (matching, linking):
        monkeypatch.setattr(
            module,
            "find_hot_keys",
            lambda *a, **k: spread.append(real(*a, **k)) or spread[-1],
        )
    try:
        check_against_scan(spark, keys, chain_after=2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert any(h.frame is not None for h in spread)


def tied(spark, rows):
    fields = "uid string, mrn string, source_id string, dob string, sex string, raw_text string, at int"
    flat = spark.createDataFrame(rows, fields)
    return flat.select("uid", "mrn", "source_id", F.struct("dob", "sex").alias("demographics"), F.struct("raw_text").alias("content"), "at")


def test_equal_lines_have_one_founder(spark):
    row = ("n", "7", "S", "1980", "F", "breast", 1)
    run = resolve(tied(spark, [row, row, row]).repartition(3), ["at"])
    assert sorted(r["rule"] for r in run.links.collect()) == ["mrn_match", "mrn_match", "new_patient"]
    stats = run.statistics.first()
    assert (stats["total_notes"], stats["total_patients"]) == (1, 1)  # uids, not lines
    assert stats["new_patient_rate"] == 1


@pytest.mark.parametrize("chain_after", [1, 6])
def test_tied_pairs_are_ordered_by_content(spark, chain_after):
    rows = [("a", "1", "S", "1980", "F", "x", 1), ("b", "1", "S", "1981", "F", "x", 1), ("c", "2", "S", "1980", "F", "x", 1)]
    got = [sorted(map(tuple, resolve(tied(spark, r), ["at"], chain_after=chain_after).links.collect())) for r in (rows, rows[::-1])]
    assert got[0] == got[1] and len(got[0]) == 3
    keyed = linking.prepare_notes(tied(spark, rows), ["at"]).orderBy("ord").collect()
    want = one_by_one([(r["mrn_key"], r["triplet"]) for r in keyed])
    rules = {r[0]: r[2] for r in got[0]}
    assert [rules[r["note_uid"]] for r in keyed] == [w[0] for w in want]


def test_a_grid_of_keys(spark):
    keys = [(f"m{i}", f"t{j}") for i in range(9) for j in range(9)]
    check_against_scan(spark, keys, chain_after=3)


def test_order_of_lines_in_files(spark, tmp_path):
    line = '{"uid": "%s", "mrn": "%s", "demographics": {"dob": "%s", "sex": "F"}}\n'
    (tmp_path / "a.jsonl").write_text(line % ("z", "1", "1980") + line % ("y", "2", "1981"))
    (tmp_path / "b.jsonl").write_text(line % ("a", "2", "1980"))
    notes = readers.read_notes(spark, str(tmp_path), with_order=True)
    rules = {r["note_uid"]: r["rule"] for r in resolve(notes, ["line"]).links.collect()}
    assert rules == {"z": "new_patient", "y": "new_patient", "a": "mrn_match"}


def sample_run(spark, **options):
    notes = spark.createDataFrame(NOTES, schemas.NOTES)
    return resolve(notes, ["uid"], run_date="20240101", timestamp="now", **options)


def test_sample_notes(spark):
    run = sample_run(spark)
    links = {r["note_uid"]: r for r in run.links.collect()}
    assert {n: (r["rule"], r["patient_uid"], r["confidence"]) for n, r in links.items()} == {
        "note_1": ("new_patient", "P0717E6B6", 1.0),
        "note_2": ("mrn_match", "P0717E6B6", 0.9),
        "note_3": ("new_patient", "P9224FF65", 1.0),
    }
    assert links["note_1"]["mrn"] == "MDA-1001"
    triplets = {r["note_uid"]: r["triplet"] for r in run.linked.collect()}
    assert triplets["note_1"] == "1980-01-01|F|adenocarcinoma|carcinoma|pancreatic"

    first = run.patients.where("patient_uid = 'P0717E6B6'").first()
    assert first["mrn_set"] == ["1001", "MDA-1001"]
    assert first["provenance"].sources == ["Source-A", "Source-B"]
    assert first["provenance"].notes_linked == 2
    assert first["diagnoses"] == ["adenocarcinoma", "carcinoma", "pancreatic cancer"]
    assert (first["demographics"].dob, first["demographics"].sex) == ("1980-01-01", "F")
    assert first["conflict_set"] is None

    stats = run.statistics.first()
    assert (stats["total_notes"], stats["total_patients"]) == (3, 2)
    assert abs(stats["new_patient_rate"] - 2 / 3) < 1e-12 and stats["triplet_match_rate"] == 0
    assert run.conflicts.isEmpty()
    report = run.report.first()
    assert report["statistics"].rule_counts == {"mrn_match": 1, "triplet_match": 0, "new_patient": 2}
    assert report["conflicts"] == [] and report["summary"].conflict_count == 0
    lines = {r["metric"]: r["value"] for r in report_summary(run.report).collect()}
    assert lines["total_notes"] == "3" and lines["mrn_match_rate"] == "33.3%"


def test_founder_only(spark):
    first = sample_run(spark, founder_only=True).patients.where("patient_uid = 'P0717E6B6'").first()
    assert first["mrn_set"] == ["MDA-1001"] and first["provenance"].sources == ["Source-A"]
    assert first["diagnoses"] == ["adenocarcinoma", "carcinoma"]
    assert first["provenance"].notes_linked == 1


def test_conflict_case(spark):
    linked = linking.link_notes(keyed_frame(spark, [("m1", "t1"), ("m2", "t1"), ("m2", "t2")]))
    rules = linked_rules(linked)
    assert [r for r, _ in rules] == ["new_patient", "triplet_match", "new_patient"]
    row, = records.link_conflicts(linked).collect()
    assert (row["type"], row["mrn"], row["triplet"]) == ("mrn_conflict", "m2", None)
    assert (row["patient_1"], row["patient_2"]) == (rules[0][1], rules[2][1])
    assert row["note_uid"] == "n2"
    sets = records.patient_conflict_sets(records.link_conflicts(linked)).collect()
    assert {r["patient_uid"]: r["conflict_set"] for r in sets} == {
        rules[0][1]: [rules[2][1]],
        rules[2][1]: [rules[0][1]],
    }


def test_missing_fields_and_identifiers(spark):
    notes = spark.createDataFrame(
        [
            {"uid": "a", "mrn": None, "demographics": None, "content": None},
            {"uid": "b", "mrn": "", "demographics": {"dob": None, "sex": ""}},
            {"uid": "c", "mrn": "1"},
            {"uid": "d", "mrn": "1"},
            {"uid": ""},
            {"uid": None},
        ],
        schemas.NOTES,
    )
    plain = resolve(notes, ["uid"]).links.orderBy("note_uid").collect()
    assert [r["rule"] for r in plain] == ["new_patient"] + ["triplet_match"] * 3
    strict = resolve(notes, ["uid"], require_identifiers=True).links.orderBy("note_uid").collect()
    assert [r["rule"] for r in strict] == ["new_patient"] * 3 + ["mrn_match"]
    assert len({r["patient_uid"] for r in strict}) == 3


def test_repeated_note_uid(spark):
    """Every line is linked; the last line of a uid supplies the content."""
    rows = [
        (0, "x", "A1", "S1", "d", "F", ["p"], "A1", "t1"),
        (1, "y", "B1", "S2", "d", "F", [], "B1", "t2"),
        (2, "x", "B1", "S3", "e", "M", ["q"], "B1", "t3"),
    ]
    linked = linking.link_notes(spark.createDataFrame(rows, KEYED))
    assert linked.count() == 3
    by_first = {r["provenance"].notes_linked: r for r in records.patient_records(linked).collect()}
    assert by_first[1]["mrn_set"] == ["B1"] and by_first[1]["diagnoses"] == ["q"]
    assert by_first[2]["provenance"].sources == ["S2", "S3"]
    stats = records.rule_statistics(linked).first()
    assert stats["total_notes"] == 2 and stats["new_patient_rate"] == 1.0
    counts = {r["rule"]: r["links"] for r in records.rule_counts(linked).collect()}
    assert counts == {"mrn_match": 1, "triplet_match": 0, "new_patient": 2}


def test_partitioning_does_not_change_links(spark):
    frame = keyed_frame(spark, random_keys(random.Random(6), 200, 50, 40))
    once = linked_rules(linking.link_notes(frame))
    again = linked_rules(linking.link_notes(frame.repartition(7).sortWithinPartitions(F.rand(1))))
    assert once == again


def test_compound_order(spark):
    notes = spark.createDataFrame(NOTES, schemas.NOTES).withColumn(
        "encounter",
        F.struct(
            F.when(F.col("uid") == "note_2", "2023").otherwise("2024").alias("ts"),
            F.lit("HPI").alias("section"),
        ),
    )
    rules = {r["note_uid"]: r["rule"] for r in resolve(notes).links.collect()}
    assert rules == {"note_1": "mrn_match", "note_2": "new_patient", "note_3": "new_patient"}


def test_empty_input(spark):
    run = resolve(spark.createDataFrame([], schemas.NOTES), ["uid"])
    assert run.links.isEmpty() and run.patients.isEmpty() and run.conflicts.isEmpty()
    stats = run.statistics.first()
    assert stats["total_notes"] == 0 and stats["mrn_match_rate"] == 0


def test_default_order_without_timestamps(spark):
    rules = {r["note_uid"]: r["rule"] for r in resolve(spark.createDataFrame(NOTES, schemas.NOTES)).links.collect()}
    assert rules == {"note_1": "new_patient", "note_2": "mrn_match", "note_3": "new_patient"}


def test_missing_order_is_an_error(spark):
    with pytest.raises(Exception, match="must not be null"):
        resolve(spark.createDataFrame(NOTES, schemas.NOTES), ["encounter.ts"])


def test_chunks_of_hot_notes_get_their_patients(spark, monkeypatch):
    monkeypatch.setattr(hot_keys, "FLOOR", 10)
    chunks = spark.range(200).select(
        F.concat(F.lit("c"), "id").alias("chunk_id"),
        F.when(F.col("id") < 90, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 30)).alias("note_uid"),
    )
    links = spark.createDataFrame(
        [("hot", "p0", 1), ("hot", "p1", 2), ("n3", "p3", 1)], "note_uid string, patient_uid string, o int"
    )
    rows = linking.chunk_links(chunks, links, "o").collect()
    assert len(rows) == 200
    assert sum(r["patient_uid"] == "p1" for r in rows) == 90
    assert sum(r["patient_uid"] == "p3" for r in rows) == 4


def test_uid_collisions(spark):
    keys = [(f"m{i}", f"t{i}") for i in range(40)]
    linked = linking.link_notes(keyed_frame(spark, keys), hex_len=1)
    shared = records.uid_collisions(linked).collect()
    assert shared and sum(r["founders"] - 1 for r in shared) == 40 - linked.select("patient_uid").distinct().count()
    assert records.uid_collisions(linking.link_notes(keyed_frame(spark, keys))).isEmpty()
