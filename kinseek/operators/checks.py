"""Required-field and type checks of output tables, as rows of violations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructType

from kinseek import schemas

# Table -> (key column, required fields, declared types by dotted path).
LINK_RULES = (
    "note_uid",
    ("note_uid", "patient_uid", "rule", "mrn", "source_id"),
    {f.name: f.dataType for f in schemas.NOTE_LINKS.fields[:5]},
)
PATIENT_RULES = (
    "patient_uid",
    ("patient_uid", "mrn_set", "demographics", "diagnoses", "provenance"),
    {
        "patient_uid": StringType(),
        "mrn_set": schemas.STRINGS,
        "demographics.dob": StringType(),
        "demographics.sex": StringType(),
        "diagnoses": schemas.STRINGS,
        "provenance.notes_linked": LongType(),
        "provenance.sources": schemas.STRINGS,
        "conflict_set": schemas.STRINGS,
    },
)


def _field_type(schema: DataType, path: str) -> DataType | None:
    for name in path.split("."):
        if not isinstance(schema, StructType) or name not in schema.names:
            return None
        schema = schema[name].dataType
    return schema


def violations(df: DataFrame, table: str, rules=LINK_RULES) -> DataFrame:
    """(table, key, field, problem) for every missing or ill-typed value, in one scan.

    A value of another type than declared is a problem unless it casts to it.
    """
    key, required, types = rules
    found = []

    def note(field, problem, condition):
        entry = F.struct(F.lit(field).alias("field"), F.lit(problem).alias("problem"))
        found.append(F.when(condition, entry))

    for field in required:
        present = _field_type(df.schema, field) is not None
        note(field, "missing", F.col(field).isNull() if present else F.lit(True))
    for field, declared in types.items():
        actual = _field_type(df.schema, field)
        if actual is None or actual.simpleString() == declared.simpleString():
            continue
        value = F.col(field)
        castable = actual.typeName() in ("string", "integer", "short", "byte", "long", "double")
        if castable and declared.typeName() in ("string", "long", "double"):
            note(field, "type", value.isNotNull() & value.try_cast(declared).isNull())
        else:
            note(field, "type", value.isNotNull())
    key_value = F.col(key).cast("string") if key in df.columns else F.lit(None).cast("string")
    return df.select(
        F.lit(table).alias("table"),
        key_value.alias("key"),
        F.explode(F.array_compact(F.array(*found))).alias("v"),
    ).select("table", "key", "v.field", "v.problem")
