"""What the tests of the training-data operators share."""

import re
import string

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash string, score double"


def words(text):
    return WORD.findall(text or "")


def read(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")
