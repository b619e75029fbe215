"""Fixed schemas of every input and output table. No reader infers a schema."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

STRING, LONG, DOUBLE = StringType(), LongType(), DoubleType()
STRINGS = ArrayType(STRING)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


DEMOGRAPHICS = _struct(dob=STRING, sex=STRING)

NOTES = _struct(
    uid=STRING,
    patient_id=STRING,
    mrn=STRING,
    source_id=STRING,
    demographics=DEMOGRAPHICS,
    content=_struct(raw_text=STRING),
    encounter=_struct(ts=STRING, section=STRING),
    provenance=_struct(
        source=STRING,
        oncologist_id=STRING,
        oncologist_name=STRING,
        ingested_from=STRING,
        checksum=STRING,
    ),
    validation=_struct(status=STRING),
)

CHUNKS = _struct(
    chunk_id=STRING,
    text=STRING,
    source_id=STRING,
    note_uid=STRING,
    offset=LONG,
    source_file=STRING,
)

CHUNK_LINKS = _struct(chunk_id=STRING, patient_uid=STRING)

NOTE_LINKS = _struct(
    note_uid=STRING,
    patient_uid=STRING,
    rule=STRING,
    mrn=STRING,
    source_id=STRING,
    confidence=DOUBLE,
)

PATIENTS = _struct(
    patient_uid=STRING,
    mrn_set=STRINGS,
    demographics=DEMOGRAPHICS,
    diagnoses=STRINGS,
    provenance=_struct(notes_linked=LONG, sources=STRINGS),
    conflict_set=STRINGS,
)

CONFLICTS = _struct(
    type=STRING,
    mrn=STRING,
    triplet=STRING,
    patient_1=STRING,
    patient_2=STRING,
    note_uid=STRING,
)

REPORT = _struct(
    timestamp=STRING,
    date=STRING,
    statistics=_struct(
        total_notes=LONG,
        total_patients=LONG,
        mrn_match_rate=DOUBLE,
        triplet_match_rate=DOUBLE,
        new_patient_rate=DOUBLE,
        rule_counts=MapType(STRING, LONG),
        conflict_count=LONG,
    ),
    conflicts=ArrayType(CONFLICTS),
    summary=_struct(
        total_patients=LONG,
        total_notes=LONG,
        conflict_count=LONG,
        mrn_match_rate=DOUBLE,
        triplet_match_rate=DOUBLE,
        new_patient_rate=DOUBLE,
    ),
)

EVIDENCE = ArrayType(_struct(token=STRING, weight=DOUBLE, pos=IntegerType()))

CANDIDATES = _struct(
    query_id=LONG,
    chunk_id=STRING,
    s_bm25=DOUBLE,
    s_dense=DOUBLE,
    source_id=STRING,
    note_uid=STRING,
    fusion_score=DOUBLE,
    rank=IntegerType(),
)

RESCORED = StructType(
    CANDIDATES.fields[:7]
    + [
        StructField("s_li", DOUBLE, True),
        StructField("evidence", EVIDENCE, True),
        StructField("rank", IntegerType(), True),
    ]
)
