"""Record linkage end to end: notes in, links, patients, conflicts and report out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from kinseek.fixed_values import DIAGNOSIS_KEY_TERMS, RECORD_DIAGNOSES, SOURCE_PREFIXES
from kinseek.operators import linking, records
from kinseek.operators.matching import CHAIN_AFTER
from kinseek.plans.report import build_report
from kinseek.runtime import stage
from kinseek.sources import writers


@dataclass(frozen=True)
class Identity:
    linked: DataFrame  # notes with keys, rule and patient, materialised
    links: DataFrame
    patients: DataFrame
    conflicts: DataFrame
    statistics: DataFrame
    report: DataFrame

    def write(self, root: str, run_date: str, fmt: str = "json") -> None:
        """All four outputs under `root`, replacing this run date only."""
        writers.write_links(self.links, root, run_date, fmt)
        writers.write_patients(self.patients, root, run_date, fmt)
        writers.write_conflicts(self.conflicts, root, run_date, fmt)
        writers.write_report(self.report, root, run_date)


def resolve(
    notes: DataFrame,
    order_by: Sequence[str] = ("encounter.ts", "uid"),
    prefixes: Mapping[str, str] = SOURCE_PREFIXES,
    lexicon: Sequence[str] = DIAGNOSIS_KEY_TERMS,
    phrases: Sequence[str] = RECORD_DIAGNOSES,
    founder_only: bool = False,
    require_identifiers: bool = False,
    hex_len: int = 8,
    run_date: str = "",
    timestamp: str = "",
    chain_after: int = CHAIN_AFTER,
) -> Identity:
    """Link every note to a patient and build the tables that follow from it.

    The notes' text is scanned once; the slim keyed notes and the linked notes are each
    written to the shared folder as Parquet, as every later step reads them again.
    """
    keyed = linking.prepare_notes(
        notes, order_by, prefixes, lexicon, phrases, require_identifiers
    )
    linked = stage(linking.link_notes(keyed, hex_len, chain_after))
    conflicts = stage(records.link_conflicts(linked))
    patients = records.patient_records(
        linked, founder_only, records.patient_conflict_sets(conflicts)
    )
    statistics = records.rule_statistics(linked)
    return Identity(
        linked=linked,
        links=linking.link_table(linked),
        patients=patients,
        conflicts=conflicts,
        statistics=statistics,
        report=build_report(statistics, conflicts, run_date, timestamp),
    )
