"""The registered queries. Each reads whole tables and returns flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinseek.functions import text as tx
from kinseek.operators import (
    bm25,
    calibrate,
    checks,
    dense,
    fusion,
    lexical,
    linking,
    ranking,
    records,
    rerank,
    word_index,
)
from kinseek.plans import cascade as retrieval
from kinseek.plans.identity import resolve
from kinseek.plans.report import report_summary
from kinseek.runtime import stage
from kinseek.sources import derived, readers

ORDER = ["ord"]
DIGITS = 6


def _round(name: str, digits: int = DIGITS):
    return F.round(name, digits).alias(name)


# --- keys and linking ---------------------------------------------------------


def _keyed(spark: SparkSession, folder: str) -> DataFrame:
    return linking.prepare_notes(derived.notes(spark, folder), ORDER)


def _linked(spark: SparkSession, folder: str) -> DataFrame:
    keyed = _keyed(spark, folder)
    return stage(linking.link_notes(keyed))


def mrn_normalize(spark, folder):
    return _keyed(spark, folder).select("note_uid", "mrn_key")


def diagnosis_key(spark, folder):
    notes = derived.notes(spark, folder)
    lowered = F.lower(F.col("content.raw_text"))
    return notes.select(F.col("uid").alias("note_uid"), lowered.alias("low")).select(
        "note_uid",
        tx.diagnosis_key(F.col("low")).alias("diagnosis_key"),
        F.concat_ws("|", tx.record_diagnoses(F.col("low"))).alias("record_diagnoses"),
    )


def triplet_key(spark, folder):
    return _keyed(spark, folder).select("note_uid", "triplet")


def patient_uid(spark, folder):
    uid = tx.patient_uid(F.col("mrn_key"), F.col("triplet"))
    return _keyed(spark, folder).select("note_uid", uid.alias("own_uid"))


def link_notes(spark, folder):
    return linking.link_table(_linked(spark, folder))


def link_notes_repeated(spark, folder):
    """Uids that repeat or are missing, and notes that tie in their order."""
    keyed = linking.prepare_notes(derived.notes(spark, folder, derived.REPEATED_COLUMNS), ORDER)
    return linking.link_table(linking.link_notes(keyed))


def link_notes_strict(spark, folder):
    """Notes without identifiers have no triplet."""
    bare = derived.notes(spark, folder, derived.BARE_COLUMNS)
    keyed = linking.prepare_notes(bare, ORDER, require_identifiers=True)
    return linking.link_table(linking.link_notes(keyed))


def patient_records_repeated(spark, folder):
    run = resolve(derived.notes(spark, folder, derived.REPEATED_COLUMNS), ORDER)
    return _flat_patients(run.patients)


def rule_stats(spark, folder):
    stats = records.rule_statistics(_linked(spark, folder))
    rates = [c for c in stats.columns if c.endswith("_rate")]
    return stats.select(*[_round(c) if c in rates else c for c in stats.columns])


def rule_counts(spark, folder):
    return records.rule_counts(_linked(spark, folder))


def _flat_patients(patients: DataFrame) -> DataFrame:
    flat = [
        "patient_uid",
        F.concat_ws("|", "mrn_set").alias("mrn_set"),
        F.col("demographics.dob").alias("dob"),
        F.col("demographics.sex").alias("sex"),
        F.concat_ws("|", "diagnoses").alias("diagnoses"),
        F.col("provenance.notes_linked").alias("notes_linked"),
        F.concat_ws("|", "provenance.sources").alias("sources"),
    ]
    if "conflict_set" in patients.columns:
        flat.append(F.concat_ws("|", "conflict_set").alias("conflict_set"))
    return patients.select(*flat)


def patient_records(spark, folder):
    run = resolve(derived.notes(spark, folder), ORDER)
    return _flat_patients(run.patients)


def patient_records_founder(spark, folder):
    return _flat_patients(records.patient_records(_linked(spark, folder), founder_only=True))


def uid_collisions(spark, folder):
    """With uids of two hex digits, so that there are collisions to report."""
    keyed = _keyed(spark, folder)
    return records.uid_collisions(linking.link_notes(keyed, hex_len=2))


def parse_notes(spark, folder):
    """Notes written as JSON lines, some broken and some with a field of another kind."""
    lines = derived.note_lines(spark, folder)
    parsed = readers.parse_notes(lines, "line")
    return parsed.select("doc_id", "uid", "mrn", F.col("demographics.dob").alias("dob"), "parses")


def chunk_patients(spark, folder):
    links = linking.link_table(_linked(spark, folder))
    return linking.chunk_links(derived.chunks(spark, folder), links)


def link_conflicts(spark, folder):
    return records.link_conflicts(_linked(spark, folder))


def patient_conflict_sets(spark, folder):
    conflicts = records.link_conflicts(_linked(spark, folder))
    return records.patient_conflict_sets(conflicts).select(
        "patient_uid", F.concat_ws("|", "conflict_set").alias("conflict_set")
    )


def patient_mrns(spark, folder):
    return records.patient_mrns(_linked(spark, folder))


def patient_conflict_pairs(spark, folder):
    return records.patient_conflict_pairs(records.link_conflicts(_linked(spark, folder)))


def report(spark, folder):
    run = resolve(
        derived.notes(spark, folder), ORDER, run_date="20240101", timestamp="2024-01-01T00:00:00"
    )
    return report_summary(run.report)


def link_schema_check(spark, folder):
    """Links of notes as they come: an empty record number counts as missing here."""
    notes = derived.notes(spark, folder)
    raw = notes.select(
        F.col("uid").alias("note_uid"),
        F.concat(F.lit("P"), "ord").alias("patient_uid"),
        F.lit("new_patient").alias("rule"),
        F.nullif("mrn", F.lit("")).alias("mrn"),
        "source_id",
    )
    return checks.violations(raw, "note_links")


def patient_schema_check(spark, folder):
    """Patient rows with `dob` only where the sex is F and a count that is not a number
    for one source."""
    raw = derived.notes(spark, folder).select(
        F.col("uid").alias("patient_uid"),
        F.when(F.col("mrn") != "", F.array("mrn")).alias("mrn_set"),
        F.when(F.col("demographics.sex") == "F", F.col("demographics")).alias("demographics"),
        F.array(F.lit("melanoma")).alias("diagnoses"),
        F.struct(
            F.when(F.col("source_id") == "Source-B", "many")
            .otherwise(F.col("ord").cast("string"))
            .alias("notes_linked"),
            F.array("source_id").alias("sources"),
        ).alias("provenance"),
    )
    return checks.violations(raw, "patients", checks.PATIENT_RULES)


# --- sources ------------------------------------------------------------------


def chunks_latest(spark, folder):
    """Documents as versions of one chunk per source and language: the last one wins."""
    versions = derived.table(spark, folder, "documents").select(
        F.concat("source", F.lit("_"), "lang").alias("chunk_id"),
        "text",
        F.col("doc_id").alias("version"),
    )
    return readers.latest_chunks(versions, ("version",)).select(
        "chunk_id", "version", F.length("text").alias("n_chars")
    )


def links_latest(spark, folder):
    links = derived.table(spark, folder, "documents").select(
        F.col("source").alias("chunk_id"), F.concat(F.lit("P"), "n_chars").alias("patient_uid"), "doc_id"
    )
    return readers.latest_links(readers.complete_links(links), "doc_id")


# --- search -------------------------------------------------------------------


def _inputs(spark, folder):
    return derived.chunks(spark, folder), derived.text_queries(spark)


def _ranked(found: DataFrame) -> DataFrame:
    return found.select("query_id", "chunk_id", _round("score"), "rank")


def lexical_topk(spark, folder):
    return _ranked(lexical.lexical_top_k(*_inputs(spark, folder)))


def presence_topk(spark, folder):
    return _ranked(lexical.presence_top_k(*_inputs(spark, folder)))


def lexical_topk_batch(spark, folder):
    queries = derived.benchmark_queries(spark, folder)
    return _ranked(lexical.lexical_top_k(derived.chunks(spark, folder), queries))


def bm25_topk(spark, folder):
    return _ranked(bm25.bm25_top_k(*_inputs(spark, folder)))


def bm25_topk_batch(spark, folder):
    queries = derived.benchmark_queries(spark, folder)
    return _ranked(bm25.bm25_top_k(derived.chunks(spark, folder), queries))


def lexical_topk_indexed(spark, folder):
    """Through a kept index: the words of each volume matched once, segments skipped by bounds."""
    index = word_index.build_index(derived.chunks(spark, folder))
    return _ranked(word_index.search_index(index, derived.benchmark_queries(spark, folder), word_index.LEXICAL))


def bm25_topk_indexed(spark, folder):
    index = word_index.build_index(derived.chunks(spark, folder))
    return _ranked(word_index.search_index(index, derived.benchmark_queries(spark, folder), word_index.BM25))


def presence_topk_indexed(spark, folder):
    index = word_index.build_index(derived.chunks(spark, folder))
    return _ranked(word_index.search_index(index, derived.text_queries(spark), word_index.PRESENCE))


def dense_cosine_topk(spark, folder):
    return _ranked(
        dense.cosine_top_k(
            derived.vectors(spark, folder), derived.label_vectors(spark, folder), 50
        )
    )


def dense_lsh_topk(spark, folder):
    return _ranked(
        dense.lsh_top_k(derived.vectors(spark, folder), derived.label_vectors(spark, folder), 50)
    )


def maxsim_rescore(spark, folder):
    candidates = dense.cosine_top_k(
        derived.mean_vector_chunks(spark, folder), derived.label_vectors(spark, folder), 20
    )
    return dense.maxsim_rescore(
        candidates,
        derived.multi_vector_chunks(spark, folder),
        derived.label_multi_vectors(spark, folder),
        10,
    )


# --- fusion -------------------------------------------------------------------


def _flat_candidates(fused: DataFrame) -> DataFrame:
    return fused.select(
        "query_id",
        "chunk_id",
        _round("s_bm25"),
        _round("s_dense"),
        "source_id",
        "note_uid",
        _round("fusion_score"),
        "rank",
    )


def fused_candidates(spark, folder):
    return _flat_candidates(retrieval.candidates(*_inputs(spark, folder)))


def fused_rank_logit(spark, folder):
    return _flat_candidates(retrieval.candidates(*_inputs(spark, folder), method="rank_logit"))


def fused_ranked_logit(spark, folder):
    return _flat_candidates(retrieval.candidates(*_inputs(spark, folder), method="ranked_logit"))


def fused_bm25_presence(spark, folder):
    """Two separate result lists, BM25 and term presence, merged by the outer join."""
    chunks, queries = _inputs(spark, folder)
    lists = fusion.merge_lists(
        bm25.bm25_top_k(chunks, queries), lexical.presence_top_k(chunks, queries)
    )
    return _flat_candidates(fusion.fuse(lists, w_bm25=0.7, w_dense=0.3))


def normalized_scores(spark, folder):
    documents = derived.table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    scaled = ranking.normalize_scores(documents, "n_chars", ["lang"], "scaled", "doc_id")
    return scaled.select("doc_id", "lang", _round("scaled"))


# --- re-ranking ---------------------------------------------------------------


def _rescored(spark, folder, **options):
    chunks, queries = _inputs(spark, folder)
    return rerank.rescore(retrieval.candidates(chunks, queries), queries, chunks, **options)


def late_interaction(spark, folder):
    return _rescored(spark, folder).select(
        "query_id", "chunk_id", _round("s_li"), _round("fusion_score"), "rank"
    )


def late_interaction_deep(spark, folder):
    """All 200 candidates scored, with all of their words."""
    return _rescored(spark, folder, depth=200).select(
        "query_id", "chunk_id", _round("s_li"), "rank"
    )


def li_evidence(spark, folder):
    rows = _rescored(spark, folder).select(
        "query_id", "chunk_id", F.posexplode("evidence").alias("item", "e")
    )
    return rows.select(
        "query_id", "chunk_id", "item", "e.token", _round("e.weight").alias("weight"), "e.pos"
    )


def _judged(spark, folder, **options):
    _, queries = _inputs(spark, folder)
    return rerank.judge(_rescored(spark, folder, evidence=False), queries, **options)


def cross_scores(spark, folder):
    return _judged(spark, folder, clip=False, k=50).select(
        "query_id", "chunk_id", _round("raw_xenc_score"), _round("calibrated_score"), "rank"
    )


def calibrated_minmax(spark, folder):
    return _flat_results(_judged(spark, folder))


def calibrated_without_labels(spark, folder):
    """Isotonic calibration with nothing to fit to: min-max."""
    return _flat_results(_judged(spark, folder, calibration="isotonic"))


def _flat_results(judged: DataFrame) -> DataFrame:
    return judged.select(
        "query_id",
        "chunk_id",
        _round("raw_xenc_score"),
        _round("calibrated_score"),
        F.col("pointers.chunk_offset").alias("chunk_offset"),
        F.col("pointers.file").alias("file"),
        "rank",
    )


def _calibrated(spark, folder, method):
    labels = stage(derived.scored_labels(spark, folder))
    scored = labels.withColumnRenamed("score", "raw")
    return calibrate.calibrate(scored, method, labels, "raw", "calibrated")


def calibrated_isotonic(spark, folder):
    return _calibrated(spark, folder, "isotonic").select("doc_id", "raw", _round("calibrated"))


def calibrated_platt(spark, folder):
    return _calibrated(spark, folder, "platt").select("doc_id", "raw", _round("calibrated", 4))


# --- whole cascade ------------------------------------------------------------


def _cascade(spark, folder, **options):
    chunks, queries = _inputs(spark, folder)
    links = linking.link_table(_linked(spark, folder))
    return retrieval.cascade(chunks, queries, links, **options), chunks, queries


def final_with_patient(spark, folder):
    run, _, _ = _cascade(spark, folder, clip=False)
    return run.final.select(
        "query_id",
        "chunk_id",
        _round("calibrated_score"),
        _round("raw_xenc_score"),
        _round("s_li"),
        _round("fusion_score"),
        "source_id",
        F.col("pointers.chunk_offset").alias("chunk_offset"),
        F.col("pointers.file").alias("file"),
        "patient_uid",
        "rank",
    )


def stage_diagnostics(spark, folder):
    return retrieval.stage_counts(*_cascade(spark, folder))


QUERIES = {
    "mrn_normalize": mrn_normalize,
    "diagnosis_key": diagnosis_key,
    "triplet_key": triplet_key,
    "patient_uid": patient_uid,
    "link_notes": link_notes,
    "link_notes_repeated": link_notes_repeated,
    "link_notes_strict": link_notes_strict,
    "patient_records_repeated": patient_records_repeated,
    "parse_notes": parse_notes,
    "rule_stats": rule_stats,
    "rule_counts": rule_counts,
    "patient_records": patient_records,
    "patient_records_founder": patient_records_founder,
    "uid_collisions": uid_collisions,
    "chunk_patients": chunk_patients,
    "link_conflicts": link_conflicts,
    "patient_conflict_sets": patient_conflict_sets,
    "patient_mrns": patient_mrns,
    "patient_conflict_pairs": patient_conflict_pairs,
    "report_summary": report,
    "link_schema_check": link_schema_check,
    "patient_schema_check": patient_schema_check,
    "chunks_latest": chunks_latest,
    "links_latest": links_latest,
    "lexical_topk": lexical_topk,
    "presence_topk": presence_topk,
    "lexical_topk_batch": lexical_topk_batch,
    "bm25_topk": bm25_topk,
    "bm25_topk_batch": bm25_topk_batch,
    "lexical_topk_indexed": lexical_topk_indexed,
    "bm25_topk_indexed": bm25_topk_indexed,
    "presence_topk_indexed": presence_topk_indexed,
    "dense_cosine_topk": dense_cosine_topk,
    "dense_lsh_topk": dense_lsh_topk,
    "maxsim_rescore": maxsim_rescore,
    "fused_candidates": fused_candidates,
    "fused_rank_logit": fused_rank_logit,
    "fused_ranked_logit": fused_ranked_logit,
    "fused_bm25_presence": fused_bm25_presence,
    "normalized_scores": normalized_scores,
    "late_interaction": late_interaction,
    "late_interaction_deep": late_interaction_deep,
    "li_evidence": li_evidence,
    "cross_scores": cross_scores,
    "calibrated_minmax": calibrated_minmax,
    "calibrated_without_labels": calibrated_without_labels,
    "calibrated_isotonic": calibrated_isotonic,
    "calibrated_platt": calibrated_platt,
    "final_with_patient": final_with_patient,
    "stage_diagnostics": stage_diagnostics,
}
