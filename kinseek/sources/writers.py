"""Writers. Dated outputs replace the folder of their own run date only."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _write_dated(df: DataFrame, path: str, run_date: str, fmt: str) -> None:
    """Overwrite one run_date= folder.

    Dynamic partition overwrite would leave an earlier run's rows in place when a rerun
    has none to write; naming the folder replaces it even then.
    """
    df.write.mode("overwrite").format(fmt).save(f"{path}/run_date={run_date}")


def write_patients(patients: DataFrame, root: str, run_date: str, fmt: str = "json") -> None:
    _write_dated(patients, f"{root}/patients", run_date, fmt)


def write_links(links: DataFrame, root: str, run_date: str, fmt: str = "json") -> None:
    _write_dated(links, f"{root}/links", run_date, fmt)


def write_conflicts(conflicts: DataFrame, root: str, run_date: str, fmt: str = "json") -> None:
    _write_dated(conflicts, f"{root}/conflicts", run_date, fmt)


def write_report(report: DataFrame, root: str, run_date: str) -> None:
    """The report is one row, so one file."""
    _write_dated(report.coalesce(1), f"{root}/identity", run_date, "json")


def write_stage(df: DataFrame, path: str, fmt: str = "json") -> None:
    """A stage's rows; JSON leaves out fields that are null."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_chunks(chunks: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Chunks by chunk_date; dates not in `chunks` are left alone."""
    (
        chunks.write.partitionBy("chunk_date")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .format(fmt)
        .save(path)
    )
