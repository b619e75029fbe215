from pyspark.sql import functions as F

from kinseek.functions import text as tx


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("v")).first()[0]


def test_normalize_mrn(spark):
    rows = [
        ("MDA-1001", "Source-A", "1001"),
        ("\t mda-1001  ", "Source-A", "1001"),
        ("BMC-2001", "Source-C", "BMC-2001"),
        ("BMC-2001", "Source-B", "2001"),
        ("CANCER-7", "Source-C", "7"),
        ("MDA-MDA-1", "Source-A", "MDA-1"),
        ("abc", None, "ABC"),
        (None, "Source-A", ""),
        ("", "Source-A", ""),
        ("MDA-5", "Source-D", "MDA-5"),
    ]
    df = spark.createDataFrame(rows, "mrn string, source string, want string")
    got = df.select(tx.normalize_mrn(F.col("mrn"), F.col("source")), "want").collect()
    assert [r[0] for r in got] == [r[1] for r in got]


def test_diagnoses(spark):
    text = F.lower(F.lit("Lung ADENOCARCINOMA, later breast cancer"))
    assert one(spark, tx.diagnosis_key(text)) == "adenocarcinoma|breast|carcinoma|lung"
    assert one(spark, tx.record_diagnoses(text)) == ["adenocarcinoma", "breast cancer", "carcinoma"]
    assert one(spark, tx.diagnosis_key(F.lit(""))) == ""
    assert one(spark, tx.record_diagnoses(F.lit("well"))) == []


def test_patient_uid(spark):
    key = "1980-01-01|F|adenocarcinoma|carcinoma|pancreatic"
    assert one(spark, tx.patient_uid(F.lit("1001"), F.lit(key))) == "P0717E6B6"
    assert (
        one(spark, tx.patient_uid(F.lit("1001"), F.lit("||adenocarcinoma|carcinoma|pancreatic")))
        == "PBF48730A"
    )
    longer = one(spark, tx.patient_uid(F.lit("1001"), F.lit(key), hex_len=16))
    assert longer.startswith("P0717E6B6") and len(longer) == 17
    alone = [one(spark, tx.patient_uid(F.lit(""), F.lit(""), F.lit(u))) for u in "ab"]
    assert alone[0] != alone[1]


def test_tokens(spark):
    assert one(spark, tx.tokens(F.lit(" A\tb C\x1cd\n"))) == ["a", "b", "c", "d"]
    assert one(spark, tx.tokens(F.lit("  "))) == []
    assert one(spark, tx.tokens(F.lit(None).cast("string"))) == []


def test_occurrences(spark):
    for text, term in [("aaaaa", "aa"), ("abcabc", "bc"), ("xyz", "q"), ("", "a"), ("été", "é")]:
        assert one(spark, tx.occurrences(F.col("t"), term), t=text) == text.count(term)
