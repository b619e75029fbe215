import pytest

import __spark_entry__ as entry
import entry_oracles
import entry_queries
from compare import oracle_connection, oracle_rows, spark_rows


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry_queries.QUERIES) == set(entry_oracles.ORACLES)


@pytest.mark.parametrize("name", sorted(entry_oracles.ORACLES))
def test_query_equals_oracle(spark, sf, name):
    names, rows = spark_rows(entry.queries()[name](spark, sf))
    oracle_names, want = oracle_rows(oracle_connection(sf), entry.oracle_sql()[name])
    assert names == oracle_names
    assert rows == want
    assert rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0
