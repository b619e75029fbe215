import json

import pytest
from pyspark.sql import functions as F

from kinseek import schemas
from kinseek.operators import checks
from kinseek.operators.rerank import attach_patients
from kinseek.plans.cascade import cascade
from kinseek.plans.identity import resolve
from kinseek.plans.report import build_report, report_summary
from kinseek.sources import readers, writers
from samples import CHUNK_PATIENTS, NOTES, QUERY, chunk_rows


def write_lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))
    return str(path)


def test_read_notes(spark, tmp_path):
    write_lines(tmp_path / "n" / "a.jsonl", [*NOTES[:2], "{broken", "", "[1,2]"])
    write_lines(tmp_path / "n" / "b.jsonl", [NOTES[2], {"uid": "", "mrn": 7}, {"uid": "z", "mrn": 1001}])
    write_lines(tmp_path / "n" / "c.json", [{"uid": "other"}])
    write_lines(tmp_path / "n" / "deep" / "d.jsonl", [{"uid": "deep"}])
    notes = readers.read_notes(spark, str(tmp_path / "n"))
    assert {r["uid"] for r in notes.collect()} == {"note_1", "note_2", "note_3", "", "z"}
    assert notes.where("uid = 'z'").first()["mrn"] == "1001"
    counts = readers.note_line_counts(spark, str(tmp_path / "n")).first()
    assert (counts["lines"], counts["bad_lines"], counts["without_uid"]) == (7, 2, 1)
    assert notes.count() == 5 and notes.select("uid").count() == 5
    assert resolve(notes, ["uid"]).links.count() == 4
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_notes(spark, str(tmp_path / "absent"))


def test_a_field_of_another_kind_does_not_cost_the_line(spark, tmp_path):
    write_lines(tmp_path / "a.jsonl", [{"uid": "q", "mrn": "1", "validation": "ok"}, {"uid": ["x"], "mrn": "2"}])
    notes = readers.read_notes(spark, str(tmp_path))
    assert notes.count() == notes.select("uid").count() == len(notes.collect()) == 2
    assert {r["mrn"]: r["validation"] for r in notes.collect()} == {"1": None, "2": None}
    assert readers.note_line_counts(spark, str(tmp_path)).first()["bad_lines"] == 0


def test_the_last_of_three_copies_in_a_file_wins(spark, tmp_path):
    lines = [{"chunk_id": "a", "text": t} for t in ("one", "two", "three")]
    for name in ("data.json", "chunks.v2"):
        path = write_lines(tmp_path / name, lines)
        assert [r["text"] for r in readers.read_chunks(spark, path).collect()] == ["three"]
    write_lines(tmp_path / "deep.jsonl" / "chunks.jsonl", lines)
    assert readers.read_chunks(spark, str(tmp_path / "deep.jsonl")).first()["text"] == "three"


def test_strict_reader(spark, tmp_path):
    good = write_lines(tmp_path / "good.jsonl", [{"chunk_id": "a"}, "", {"chunk_id": "b"}])
    assert readers.read_jsonl(spark, good, schemas.CANDIDATES).count() == 2
    bad = write_lines(tmp_path / "bad.jsonl", [{"chunk_id": "a"}, "{oops"])
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_jsonl(spark, bad, schemas.CANDIDATES).collect()


def test_read_chunks(spark, tmp_path):
    row = lambda i, text: {"chunk_id": i, "text": text, "offset": 5}
    write_lines(tmp_path / "c" / "2024-01-01" / "chunks.jsonl", [row("a", "old"), row("b", "only")])
    write_lines(tmp_path / "c" / "2024-02-01" / "chunks.jsonl", [row("a", "new")])
    write_lines(tmp_path / "c" / "2024-02-01" / "other.jsonl", [row("x", "no")])
    chunks = readers.read_chunks(spark, str(tmp_path / "c"))
    rows = {r["chunk_id"]: r for r in chunks.collect()}
    assert {i: (r["text"], r["chunk_date"]) for i, r in rows.items()} == {
        "a": ("new", "2024-02-01"),
        "b": ("only", "2024-01-01"),
    }
    assert rows["a"]["offset"] == 5
    assert readers.chunk_column(chunks, "a") == "new"
    assert readers.chunk_column(chunks, "a", "source_id") == ""
    with pytest.raises(KeyError):
        readers.chunk_column(chunks, "zzz")
    single = readers.read_chunks(spark, str(tmp_path / "c" / "2024-01-01" / "chunks.jsonl"))
    assert {r["text"] for r in single.collect()} == {"old", "only"}
    writers.write_chunks(chunks, str(tmp_path / "native"))
    native = spark.read.parquet(str(tmp_path / "native"))
    assert native.where("chunk_date = '2024-02-01'").count() == 1


def test_read_chunk_links(spark, tmp_path):
    assert readers.read_chunk_links(spark, None).isEmpty()
    path = write_lines(
        tmp_path / "links.jsonl",
        [{"chunk_id": "a", "patient_uid": "p"}, {"chunk_id": "b"}, {"patient_uid": "p"}, "{bad",
         {"chunk_id": "", "patient_uid": "p"}],
    )
    assert [tuple(r) for r in readers.read_chunk_links(spark, path).collect()] == [("a", "p")]


def test_identity_outputs(spark, tmp_path):
    notes = spark.createDataFrame(NOTES, schemas.NOTES)
    root = str(tmp_path / "out")
    resolve(notes, ["uid"], run_date="20240101", timestamp="t").write(root, "20240101")
    resolve(notes.limit(2), ["uid"], run_date="20240102", timestamp="t").write(root, "20240102")
    resolve(notes.where("uid <> 'note_3'"), ["uid"], run_date="20240102", timestamp="t").write(root, "20240102")
    read = lambda name, schema: spark.read.schema(schema).json(f"{root}/{name}")
    links = read("links", schemas.NOTE_LINKS.add("run_date", "string"))
    per_day = {r["run_date"]: r["count"] for r in links.groupBy("run_date").count().collect()}
    assert per_day == {"20240101": 3, "20240102": 2}
    patients = read("patients", schemas.PATIENTS.add("run_date", "string"))
    assert patients.where("run_date = '20240101'").count() == 2
    text = spark.read.text(f"{root}/patients/run_date=20240101").collect()
    assert not any("conflict_set" in r[0] for r in text)
    saved = readers.read_report(spark, f"{root}/identity/run_date=20240101")
    lines = {r["metric"]: r["value"] for r in report_summary(saved).collect()}
    assert lines["total_patients"] == "2" and lines["date"] == "20240101"
    assert read("conflicts", schemas.CONFLICTS).isEmpty()


def test_rerun_without_conflicts_replaces_them(spark, tmp_path):
    root = str(tmp_path)
    row = ("mrn_conflict", "m", None, "p", "q", "n")
    df = spark.createDataFrame([row], schemas.CONFLICTS)
    writers.write_conflicts(df, root, "d1", "parquet")
    writers.write_conflicts(df, root, "d2", "parquet")
    writers.write_conflicts(df.limit(0), root, "d1", "parquet")
    left = spark.read.parquet(f"{root}/conflicts").select("run_date").collect()
    assert [r[0] for r in left] == ["d2"]


def test_saved_report(spark, tmp_path):
    rates = {"mrn_match_rate": 0.125, "triplet_match_rate": 0.25, "new_patient_rate": 0.625}
    conflict = {"type": "triplet_conflict", "triplet": "t", "patient_1": "a", "patient_2": "b"}
    body = {
        "timestamp": "2031-05-06T07:08:09",
        "date": "20310506",
        "conflicts": [conflict] * 12,
        "summary": {"total_patients": 5, "total_notes": 8, "conflict_count": 12, **rates},
    }
    path = tmp_path / "report.json"
    path.write_text(json.dumps(body, indent=2))
    rows = report_summary(readers.read_report(spark, str(path))).orderBy("position").collect()
    lines = {r["metric"]: r["value"] for r in rows}
    assert lines["total_notes"] == "8" and lines["mrn_match_rate"] == "12.5%"
    assert lines["conflict_10"] == "one triplet is held by a, b"
    assert "conflict_11" not in lines and lines["more_conflicts"] == "2"
    path.write_text("{}")
    bare = {r["metric"]: r["value"] for r in report_summary(readers.read_report(spark, str(path))).collect()}
    assert bare["date"] == "Unknown" and bare["total_notes"] == "0" and len(bare) == 8


def test_stage_outputs(spark, tmp_path):
    chunks = spark.createDataFrame(chunk_rows(), schemas.CHUNKS)
    queries = spark.createDataFrame([(0, QUERY)], "query_id long, query string")
    links = spark.createDataFrame([("chunk_001", "patient_123")], schemas.CHUNK_LINKS)
    cascade(chunks, queries, links).write(str(tmp_path))
    final = [json.loads(r[0]) for r in spark.read.text(f"{tmp_path}/final").collect()]
    assert len(final) == 5
    assert [r.get("patient_uid") for r in final if r["chunk_id"] == "chunk_001"] == ["patient_123"]
    assert all("patient_uid" not in r for r in final if r["chunk_id"] != "chunk_001")
    back = readers.read_jsonl(spark, f"{tmp_path}/rescored", schemas.RESCORED)
    assert back.where(F.size("evidence") > 0).count() == 5
    assert not {"text", "offset"} & set(back.columns)


def test_violations(spark):
    links = spark.createDataFrame(
        [("n1", "p", "r", "m", "s"), ("n2", None, "r", None, "s")],
        "note_uid string, patient_uid string, rule string, mrn string, source_id string",
    )
    got = {(r["key"], r["field"], r["problem"]) for r in checks.violations(links, "links").collect()}
    assert got == {("n2", "patient_uid", "missing"), ("n2", "mrn", "missing")}
    no_rule = checks.violations(links.drop("rule"), "links").where("field = 'rule'")
    assert no_rule.count() == 2
    typed = links.withColumn("mrn", F.array("mrn"))
    assert checks.violations(typed, "links").where("problem = 'type'").count() == 2


def test_complete_links_and_last_link(spark):
    rows = [("a", "p1", 1), ("a", "p2", 2), ("b", "", 1), (None, "p", 1), ("c", "p3", 1)]
    links = spark.createDataFrame(rows, "chunk_id string, patient_uid string, ord int")
    got = readers.latest_links(readers.complete_links(links), "ord").collect()
    assert {tuple(r) for r in got} == {("a", "p2"), ("c", "p3")}
    assert CHUNK_PATIENTS["chunk_005"] == "patient_789"


def test_lines_with_more_than_one_object_do_not_parse(spark):
    good = ['{"uid":"a"}', ' {"uid":"b","n":{"x":[1,2]}} ', "{}", '{"uid":"c","uid":"d"}']
    bad = ['{"uid":"t"} trailing', '{"a":1},{"b":2}', '{"a":1}] [{"b":2}', '{"a":1}} {', '{"v":1}, "w":{"a":2}', '{"a":1} {"b":2}', "[1]", "5", "null", '{"a":1', "{'a':1}", ""]
    rows = readers.parse_notes(spark.createDataFrame([(x,) for x in good + bad], "value string").coalesce(1), "value").collect()
    assert [r["parses"] for r in rows] == [True] * len(good) + [False] * len(bad)
    assert [r["uid"] for r in rows[:2]] == ["a", "b"]


def test_last_line_of_a_chunk_wins(spark, tmp_path):
    lines = [("c1", "z"), ("c2", "p"), ("c1", "m"), ("c1", "a"), ("c1", ""), (None, "x")]
    path = tmp_path / "links.jsonl"
    path.write_text("".join(json.dumps({"chunk_id": c, "patient_uid": p}) + "\n" for c, p in lines) + "{broken\n")
    links = readers.read_chunk_links(spark, str(path), with_order=True)
    assert {r["chunk_id"]: r["patient_uid"] for r in readers.latest_links(links).collect()} == {"c1": "a", "c2": "p"}
    results = spark.createDataFrame([("c1",), ("c3",)], "chunk_id string")
    got = {r["chunk_id"]: r["patient_uid"] for r in attach_patients(results, links).collect()}
    assert got == {"c1": "a", "c3": None}
    assert readers.latest_links(readers.read_chunk_links(spark, None, with_order=True)).collect() == []


def test_whole_report_has_all_conflicts(spark, tmp_path):
    made = [("mrn_conflict", f"m{i:02}", None, f"P{i}", f"Q{i}", f"n{i}") for i in range(25)]
    conflicts = spark.createDataFrame(made, schemas.CONFLICTS)
    totals = "1L AS total_notes, 1L AS total_patients, 0D AS mrn_match_rate, 0D AS triplet_match_rate, 1D AS new_patient_rate"
    counts = "0L AS mrn_match_count, 0L AS triplet_match_count, 1L AS new_patient_count"
    report = build_report(spark.sql(f"SELECT {totals}, {counts}"), conflicts, "20240101", "t")
    writers.write_conflicts(conflicts, str(tmp_path), "20240101")
    writers.write_report(report, str(tmp_path), "20240101")
    header, everything = readers.read_whole_report(spark, str(tmp_path), "20240101")
    assert sorted(map(tuple, everything.collect())) == sorted(map(tuple, conflicts.collect()))
    assert header.first()["summary"].conflict_count == 25
    lines = {r["metric"]: r["value"] for r in report_summary(header).collect()}
    assert lines["conflict_count"] == "25" and lines["more_conflicts"] == "15"
