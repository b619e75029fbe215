"""Column expressions for identifiers, keys and text. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinseek.fixed_values import (
    DIAGNOSIS_KEY_TERMS,
    RECORD_DIAGNOSES,
    RULE_CONFIDENCE,
    SOURCE_PREFIXES,
)

# Unicode white space plus the four ASCII separators; trim() would leave tabs.
_SPACE = r"[\s\x1c-\x1f]+"


def or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def strip(value: Column) -> Column:
    return F.regexp_replace(value, f"(?U)^{_SPACE}|{_SPACE}$", "")


def tokens(text: Column) -> Column:
    """Lower-case, white-space separated, no empty tokens."""
    return F.array_remove(F.split(F.lower(or_empty(text)), f"(?U){_SPACE}"), "")


def normalize_mrn(
    mrn: Column, source_id: Column, prefixes: Mapping[str, str] = SOURCE_PREFIXES
) -> Column:
    """Strip, upper-case, and drop the prefix the note's own source uses."""
    clean = F.upper(strip(or_empty(mrn)))
    result = None
    for source, prefix in prefixes.items():
        applies = (source_id == source) & F.startswith(clean, F.lit(prefix))
        bare = F.substring(clean, len(prefix) + 1, 2**31 - 1)
        result = F.when(applies, bare) if result is None else result.when(applies, bare)
    return clean if result is None else result.otherwise(clean)


def diagnosis_key(lowered: Column, terms: Sequence[str] = DIAGNOSIS_KEY_TERMS) -> Column:
    """The terms found in an already lower-cased text, sorted and joined by '|'."""
    found = [F.when(F.contains(lowered, F.lit(t)), F.lit(t)) for t in sorted(terms)]
    return F.concat_ws("|", *found)


def record_diagnoses(lowered: Column, phrases: Sequence[str] = RECORD_DIAGNOSES) -> Column:
    """The phrases found in an already lower-cased text, as a sorted array.

    Joined and split again because that, unlike filtering an array, is compiled.
    """
    found = [F.when(F.contains(lowered, F.lit(p)), F.lit(p)) for p in sorted(phrases)]
    return F.array_remove(F.split(F.concat_ws("|", *found), r"\|"), "")


def triplet_key(dob: Column, sex: Column, diagnosis: Column) -> Column:
    return F.concat(or_empty(dob), F.lit("|"), or_empty(sex), F.lit("|"), diagnosis)


def patient_uid(
    mrn_key: Column, triplet: Column, note_uid: Column | None = None, hex_len: int = 8
) -> Column:
    """'P' and the first hex digits of SHA-256 over the keys that are present.

    With neither key present the note's own uid stands in, where it is given.
    """
    joined = F.concat_ws(
        "|",
        F.when(mrn_key != "", F.concat(F.lit("mrn:"), mrn_key)),
        F.when(triplet != "", F.concat(F.lit("triplet:"), triplet)),
    )
    if note_uid is not None:
        joined = F.when(joined == "", F.concat(F.lit("note:"), note_uid)).otherwise(joined)
    return F.concat(F.lit("P"), F.upper(F.substring(F.sha2(joined, 256), 1, hex_len)))


def rule_confidence(rule: Column) -> Column:
    result = None
    for name, value in RULE_CONFIDENCE.items():
        result = F.when(rule == name, value) if result is None else result.when(rule == name, value)
    return result


def occurrences(lowered: Column, term: str) -> Column:
    """How often `term` occurs in a lower-cased text, counted without overlaps."""
    removed = F.length(lowered) - F.length(F.replace(lowered, F.lit(term), F.lit("")))
    return F.when(
        F.contains(lowered, F.lit(term)), (removed / F.lit(len(term))).cast("int")
    ).otherwise(0)


def contains_either_way(term: Column, word: Column) -> Column:
    return F.contains(word, term) | F.contains(term, word)


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
