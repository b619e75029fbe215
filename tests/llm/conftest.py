import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import DOCS  # noqa: E402


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows and ids, clashing column names."""
    base = "The quick brown fox jumps over the lazy dog while nine old owls watch from tall trees nearby tonight again"
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    rows = [
        (1, base),
        (2, base.upper()),
        (3, base.replace("lazy", "idle")),
        (4, ""),
        (5, None),
        (6, " \t\n "),
        (7, "two words"),
        (8, "two  words"),
        (9, long),
        (10, long + " tail"),
        (11, "x" * 70_000),
        (12, base),
        (12, base),
        (None, base),
        (None, None),
        (14, "naïve café   \U0001f600 done"),
        (15, "one two three four"),
        (16, "ONE two three four"),
    ]
    return spark.createDataFrame([(i, t, None, None if i in (5, 7) else f"s{(i or 0) % 3}", 0, "h", 0.5) for i, t in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
