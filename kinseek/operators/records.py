"""From linked notes: patient records, conflicts, conflict sets, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.fixed_values import RULE_CONFIDENCE
from kinseek.operators.hot_keys import HotKeys, find_hot_keys, lookup_join
from kinseek.runtime import stage


_CONTENT = ("mrn", "source_id", "dob", "sex", "diagnoses")


def _last_content(linked: DataFrame) -> tuple[DataFrame, HotKeys] | None:
    """Content of the last line of every note uid that comes more than once."""
    repeated = stage(
        linked.groupBy("note_uid")
        .agg(F.count(F.lit(1)).alias("lines"))
        .where("lines > 1")
    )
    if repeated.isEmpty():
        return None
    hot = find_hot_keys(repeated, ["note_uid"], weight="lines")
    lines = lookup_join(linked, repeated.select("note_uid"), hot, "left_semi", ["ord"])
    last = lines.groupBy("note_uid").agg(F.max_by(F.struct(*_CONTENT), "ord").alias("last"))
    return last, hot


def patient_members(linked: DataFrame, founder_only: bool = False) -> DataFrame:
    """One row per (patient, note) with the note's latest content.

    A note uid may come more than once: every line is linked, the last one supplies the
    content. Where all uids are distinct, which a count of the uids shows, the linked
    notes are the members as they stand. `founder_only` keeps just the note that founded
    each patient.
    """
    kept = linked.where("rule = 'new_patient'") if founder_only else linked
    repeated = _last_content(linked)
    if repeated is None:
        return kept.select("patient_uid", "note_uid", F.col("ord").alias("first_ord"), *_CONTENT)
    last, hot = repeated
    members = kept.groupBy("patient_uid", "note_uid").agg(
        F.min("ord").alias("first_ord"), F.max_by(F.struct(*_CONTENT), "ord").alias("own")
    )
    return (
        lookup_join(members, last, hot, "left", ["patient_uid"])
        .withColumn("note", F.coalesce("last", "own"))
        .select("patient_uid", "note_uid", "first_ord", "note.*")
    )


def patient_records(
    linked: DataFrame, founder_only: bool = False, conflict_sets: DataFrame | None = None
) -> DataFrame:
    """Entity records. Every array holds distinct values in sorted order.

    Sets are combined map-side, so what reaches the task of a very frequent patient is
    its distinct values. Demographics come from the patient's first note.
    """
    diagnosis_sets = F.collect_set("diagnoses")
    records = (
        patient_members(linked, founder_only)
        .groupBy("patient_uid")
        .agg(
            F.sort_array(F.collect_set(F.nullif("mrn", F.lit("")))).alias("mrn_set"),
            F.min_by(F.struct("dob", "sex"), "first_ord").alias("demographics"),
            F.sort_array(F.array_distinct(F.flatten(diagnosis_sets))).alias("diagnoses"),
            F.struct(
                F.count(F.lit(1)).alias("notes_linked"),
                F.sort_array(F.collect_set(F.nullif("source_id", F.lit("")))).alias("sources"),
            ).alias("provenance"),
        )
    )
    if conflict_sets is not None:
        records = records.join(conflict_sets, "patient_uid", "left")
    return records


def link_conflicts(linked: DataFrame) -> DataFrame:
    """Keys that span several patients.

    One row per later patient of such a key: patient_1 is the key's earliest patient,
    patient_2 the other one, note_uid that one's first note with the key.
    """
    keys = F.array(
        F.struct(F.lit("mrn").alias("kind"), F.col("mrn_key").alias("key")),
        F.struct(F.lit("triplet").alias("kind"), F.col("triplet").alias("key")),
    )
    holders = stage(
        linked.select(F.explode(keys).alias("k"), "patient_uid", "ord", "note_uid")
        .where("k.key <> ''")
        .groupBy("k.kind", "k.key", "patient_uid")
        .agg(F.min(F.struct("ord", "note_uid")).alias("seen"))
    )
    shared = (
        holders.groupBy("kind", "key")
        .agg(
            F.min(F.struct("seen", "patient_uid")).alias("earliest"),
            F.count(F.lit(1)).alias("patients"),
        )
        .where("patients > 1")
        .select("kind", "key", F.col("earliest.patient_uid").alias("patient_1"))
    )
    hot = find_hot_keys(holders, ["kind", "key"])
    spread = lookup_join(holders, shared, hot, "inner", ["patient_uid"])
    return spread.where("patient_uid <> patient_1").select(
        F.concat("kind", F.lit("_conflict")).alias("type"),
        F.when(F.col("kind") == "mrn", F.col("key")).alias("mrn"),
        F.when(F.col("kind") == "triplet", F.col("key")).alias("triplet"),
        "patient_1",
        F.col("patient_uid").alias("patient_2"),
        F.col("seen.note_uid").alias("note_uid"),
    )


def patient_mrns(linked: DataFrame, founder_only: bool = False) -> DataFrame:
    """One row per patient and record number: the long form of `mrn_set`, without its bound.

    Nothing but distinct pairs is grouped, so a patient's number of values has no limit.
    """
    members = patient_members(linked, founder_only)
    return members.where("mrn <> ''").select("patient_uid", "mrn").distinct()


def patient_conflict_pairs(conflicts: DataFrame) -> DataFrame:
    """One row per patient and other patient in conflict with it: the long form of
    `patient_conflict_sets`, which holds all others of one patient in one row."""
    both_ways = conflicts.select(
        F.explode(
            F.array(
                F.struct(F.col("patient_1").alias("patient_uid"), F.col("patient_2").alias("other")),
                F.struct(F.col("patient_2").alias("patient_uid"), F.col("patient_1").alias("other")),
            )
        ).alias("p")
    ).select("p.*")
    return both_ways.distinct()


def patient_conflict_sets(conflicts: DataFrame) -> DataFrame:
    """The other patients each patient is in conflict with."""
    return (
        patient_conflict_pairs(conflicts)
        .groupBy("patient_uid")
        .agg(F.sort_array(F.collect_list("other")).alias("conflict_set"))
    )


def uid_collisions(linked: DataFrame) -> DataFrame:
    """Patient uids that several founders share: hash collisions, which merge patients.

    Eight hex digits make them likely from some 65,000 patients on; use a larger
    `hex_len` there.
    """
    return (
        linked.where("rule = 'new_patient'")
        .groupBy("patient_uid")
        .agg(
            F.count(F.lit(1)).alias("founders"),
            F.min(F.struct("ord", "note_uid")).alias("first"),
        )
        .where("founders > 1")
        .select("patient_uid", "founders", F.col("first.note_uid").alias("first_note"))
    )


def rule_statistics(linked: DataFrame) -> DataFrame:
    """One row: totals, count and rate of each rule. Rates are lines per distinct note."""
    rules = list(RULE_CONFIDENCE)
    per_note = linked.groupBy("note_uid").agg(
        *[F.count_if(F.col("rule") == r).alias(f"{r}_count") for r in rules]
    )
    notes = per_note.agg(
        F.count(F.lit(1)).alias("total_notes"),
        F.lit(0).cast("long").alias("total_patients"),
        *[F.coalesce(F.sum(f"{r}_count"), F.lit(0)).alias(f"{r}_count") for r in rules],
    )
    patients = (
        linked.where("rule = 'new_patient'")
        .groupBy("patient_uid")
        .agg(F.count(F.lit(1)))
        .agg(
            F.lit(0).cast("long").alias("total_notes"),
            F.count(F.lit(1)).alias("total_patients"),
            *[F.lit(0).cast("long").alias(f"{r}_count") for r in rules],
        )
    )
    both = notes.unionByName(patients)
    totals = both.agg(*[F.sum(c).alias(c) for c in both.columns])
    rates = [
        F.coalesce(F.try_divide(F.col(f"{r}_count"), F.col("total_notes")), F.lit(0.0)).alias(
            f"{r}_rate"
        )
        for r in rules
    ]
    return totals.select("*", *rates)


def rule_counts(linked: DataFrame) -> DataFrame:
    """Links per rule, with a row for every rule even where it never fired."""
    stats = rule_statistics(linked)
    pairs = F.array(
        *[
            F.struct(F.lit(r).alias("rule"), F.col(f"{r}_count").alias("links"))
            for r in RULE_CONFIDENCE
        ]
    )
    return stats.select(F.explode(pairs).alias("r")).select("r.*")
