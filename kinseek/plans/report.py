"""The run report: one nested row, and its summary as (metric, value) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.fixed_values import REPORT_CONFLICTS, RULE_CONFIDENCE
from kinseek.operators.ranking import SPREAD, top_k

_RATES = [f"{rule}_rate" for rule in RULE_CONFIDENCE]
_CONFLICT = ("type", "mrn", "triplet", "patient_1", "patient_2", "note_uid")


def first_conflicts(conflicts: DataFrame, n: int = REPORT_CONFLICTS) -> DataFrame:
    """The conflicts a report shows, in a fixed order, numbered from 1."""
    order = [F.col(c).asc_nulls_first() for c in _CONFLICT]
    return top_k(
        conflicts.withColumn("_all", F.lit(0)), ["_all"], order, n, spread=SPREAD
    ).drop("_all")


def build_report(
    statistics: DataFrame,
    conflicts: DataFrame,
    run_date: str,
    timestamp: str,
    shown: int = REPORT_CONFLICTS,
) -> DataFrame:
    """One row. The conflicts stay in their own table; the report counts them all and
    carries the first `shown`."""
    listed = (
        first_conflicts(conflicts, shown)
        .agg(F.array_sort(F.collect_list(F.struct("rank", *_CONFLICT))).alias("c"))
        .select(
            F.transform("c", lambda x: F.struct(*[x[f].alias(f) for f in _CONFLICT])).alias(
                "conflicts"
            ),
            F.lit("report").alias("_one"),
        )
    )
    counted = conflicts.agg(
        F.count(F.lit(1)).alias("conflict_count"), F.lit("report").alias("_one")
    )
    counts = F.map_from_arrays(
        F.array(*[F.lit(r) for r in RULE_CONFIDENCE]),
        F.array(*[F.col(f"{r}_count") for r in RULE_CONFIDENCE]),
    )
    row = (
        statistics.withColumn("_one", F.lit("report")).join(counted, "_one").join(listed, "_one")
    )
    return row.select(
        F.lit(timestamp).alias("timestamp"),
        F.lit(run_date).alias("date"),
        F.struct(
            "total_notes",
            "total_patients",
            *_RATES,
            counts.alias("rule_counts"),
            "conflict_count",
        ).alias("statistics"),
        "conflicts",
        F.struct("total_patients", "total_notes", "conflict_count", *_RATES).alias("summary"),
    )


def _conflict_line(c):
    patients = F.concat_ws(", ", c["patient_1"], c["patient_2"])
    return (
        F.when(
            c["type"] == "mrn_conflict",
            F.concat(F.lit("record number "), c["mrn"], F.lit(" is held by "), patients),
        )
        .when(
            c["type"] == "triplet_conflict",
            F.concat(F.lit("one triplet is held by "), patients),
        )
        .otherwise(c["type"])
    )


def report_summary(report: DataFrame, shown: int = REPORT_CONFLICTS) -> DataFrame:
    """(position, metric, value) rows: dates, totals, rates, the first conflicts, the rest."""

    def line(position, metric, value):
        return F.struct(
            F.lit(position).alias("position"), F.lit(metric).alias("metric"), value.alias("value")
        )

    s = F.col("summary")
    known = lambda c: F.coalesce(c, F.lit("Unknown"))
    total = lambda f: F.coalesce(s[f], F.lit(0)).cast("string")
    rate = lambda f: F.concat(
        F.format_number(F.coalesce(s[f], F.lit(0.0)) * 100, 1), F.lit("%")
    )
    fixed = F.array(
        line(1, "date", known(F.col("date"))),
        line(2, "timestamp", known(F.col("timestamp"))),
        line(3, "total_notes", total("total_notes")),
        line(4, "total_patients", total("total_patients")),
        line(5, "conflict_count", total("conflict_count")),
        line(6, "mrn_match_rate", rate("mrn_match_rate")),
        line(7, "triplet_match_rate", rate("triplet_match_rate")),
        line(8, "new_patient_rate", rate("new_patient_rate")),
    )
    items = F.transform(
        F.slice("conflicts", 1, shown),
        lambda c, i: F.struct(
            (i + 9).alias("position"),
            F.concat(F.lit("conflict_"), (i + 1).cast("string")).alias("metric"),
            _conflict_line(c).alias("value"),
        ),
    )
    # A saved report may list more conflicts than its count says, or only the first few.
    known_total = F.greatest(F.coalesce(s["conflict_count"], F.lit(0)), F.size("conflicts"))
    rest = F.array(line(9 + shown, "more_conflicts", (known_total - shown).cast("string")))
    more = F.when(known_total > shown, rest).otherwise(F.array())
    lines = F.concat(fixed, F.coalesce(items, F.array()), more)
    return report.select(F.explode(lines).alias("l")).select("l.*")
