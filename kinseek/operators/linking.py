"""Notes to entities: keys per note, then the rule and entity of every note."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinseek.fixed_values import DIAGNOSIS_KEY_TERMS, RECORD_DIAGNOSES, SOURCE_PREFIXES
from kinseek.functions import text as tx
from kinseek.operators.hot_keys import find_hot_keys, lookup_join
from kinseek.operators.matching import CHAIN_AFTER, distinct_pairs, founding_pairs, hot_sides
from kinseek.runtime import stage


def prepare_notes(
    notes: DataFrame,
    order_by: Sequence[str] = ("encounter.ts", "uid"),
    prefixes: Mapping[str, str] = SOURCE_PREFIXES,
    lexicon: Sequence[str] = DIAGNOSIS_KEY_TERMS,
    phrases: Sequence[str] = RECORD_DIAGNOSES,
    require_identifiers: bool = False,
) -> DataFrame:
    """The slim form of the notes: keys and record fields, no text.

    The text is read once, here, and the result is written to the shared folder. `order_by`
    names the columns that say which note came first. Notes that tie in them are ordered
    by `tie_breaker`, a digest of their content, and equal notes by their place in the
    scan, so every note has a place of its own; nulls come first, but a single order column
    must not be null. Missing values count as empty. With `require_identifiers` a note lacking birth date, sex and diagnosis has no
    triplet.
    """
    order = [F.col(c) for c in order_by]
    if len(order) == 1:
        missing = F.raise_error(F.lit(f"{order_by[0]} orders the notes and must not be null"))
        order = [F.coalesce(order[0], missing)]
    position = F.struct(
        *[c.alias(f"o{i}") for i, c in enumerate(order)],
        tie_breaker().alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    first = notes.where((F.col("uid").isNotNull()) & (F.col("uid") != "")).select(
        F.col("uid").alias("note_uid"),
        position.alias("ord"),
        tx.or_empty(F.col("mrn")).alias("mrn"),
        tx.or_empty(F.col("source_id")).alias("source_id"),
        F.col("demographics.dob").alias("dob"),
        F.col("demographics.sex").alias("sex"),
        F.lower(tx.or_empty(F.col("content.raw_text"))).alias("_lowered"),
    )
    diagnosis = tx.diagnosis_key(F.col("_lowered"), lexicon)
    keyed = first.select(
        "note_uid",
        "ord",
        "mrn",
        "source_id",
        "dob",
        "sex",
        tx.record_diagnoses(F.col("_lowered"), phrases).alias("diagnoses"),
        tx.normalize_mrn(F.col("mrn"), F.col("source_id"), prefixes).alias("mrn_key"),
        tx.triplet_key(F.col("dob"), F.col("sex"), diagnosis).alias("triplet"),
    )
    if require_identifiers:
        keyed = keyed.withColumn(
            "triplet", F.when(F.col("triplet") == "||", "").otherwise(F.col("triplet"))
        )
    return stage(keyed)


def tie_breaker() -> Column:
    """Orders notes that tie by what they say."""
    fields = ("uid", "mrn", "source_id", "demographics.dob", "demographics.sex", "content.raw_text")
    return F.substring(F.md5(F.concat_ws("|", *[tx.or_empty(F.col(f)) for f in fields])), 1, 16)


def link_notes(
    keyed: DataFrame, hex_len: int = 8, chain_after: int = CHAIN_AFTER
) -> DataFrame:
    """Add patient_uid, rule and confidence to prepared notes.

    Matching runs on distinct key pairs; the notes themselves are shuffled once. An
    earlier founder with the note's record number wins, then an earlier founder with its
    triplet, else the note is the founder.
    """
    pairs = stage(distinct_pairs(keyed))
    sizes = pairs.agg(F.count(F.lit(1)), F.coalesce(F.sum("notes"), F.lit(0))).first()
    hot = hot_sides(pairs, total=sizes[0])
    founders = founding_pairs(pairs, hot, chain_after).withColumn(
        "uid", tx.patient_uid(F.col("mrn_key"), F.col("triplet"), hex_len=hex_len)
    )

    decided = pairs
    for side, tag in (("mrn_key", "m"), ("triplet", "t")):
        by_key = founders.where(F.col(side) != "").select(
            side, F.col("ord").alias(f"{tag}_ord"), F.col("uid").alias(f"{tag}_uid")
        )
        decided = lookup_join(decided, by_key, hot[side], "left", ["ord"])
    decided = stage(
        decided.select("mrn_key", "triplet", "notes", "m_ord", "m_uid", "t_ord", "t_uid")
    )

    hot_pairs = find_hot_keys(decided, ["mrn_key", "triplet"], weight="notes", total=sizes[1])
    linked = lookup_join(keyed, decided.drop("notes"), hot_pairs, "left", ["note_uid", "ord"])
    rule = (
        F.when(F.col("m_ord") < F.col("ord"), "mrn_match")
        .when(F.col("t_ord") < F.col("ord"), "triplet_match")
        .otherwise("new_patient")
    )
    own = F.coalesce(
        "m_uid", "t_uid", tx.patient_uid(F.lit(""), F.lit(""), F.col("note_uid"), hex_len)
    )
    entity = (
        F.when(F.col("rule") == "mrn_match", F.col("m_uid"))
        .when(F.col("rule") == "triplet_match", F.col("t_uid"))
        .otherwise(own)
    )
    return (
        linked.withColumn("rule", rule)
        .withColumn("patient_uid", entity)
        .withColumn("confidence", tx.rule_confidence(F.col("rule")))
        .select(*keyed.columns, "patient_uid", "rule", "confidence")
    )


def link_table(linked: DataFrame) -> DataFrame:
    """The note-to-patient link rows that are written out."""
    return linked.select("note_uid", "patient_uid", "rule", "mrn", "source_id", "confidence")


def chunk_links(chunks: DataFrame, links: DataFrame, order: str | None = None) -> DataFrame:
    """Patient of every chunk through the note it comes from, null where there is none.

    Of several links of a note the last in `order` counts (the largest patient uid where
    no order is given). A note may have any number of chunks.
    """
    last = F.max("patient_uid") if order is None else F.max_by("patient_uid", order)
    per_note = links.groupBy("note_uid").agg(last.alias("patient_uid"))
    slim = stage(chunks.select("chunk_id", "note_uid"))
    hot = find_hot_keys(slim, ["note_uid"])
    joined = lookup_join(slim, per_note, hot, "left", ["chunk_id"])
    return joined.select("chunk_id", "patient_uid")
