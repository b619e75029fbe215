import pytest
from compare import oracle_connection, oracle_rows, spark_rows
from kinseek.llm.oracles import ORACLES
from kinseek.llm.queries import QUERIES


def test_queries_and_oracles():
    assert set(ORACLES) < set(QUERIES)
    assert len(QUERIES) == 14


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf, name):
    names, rows = spark_rows(QUERIES[name](spark, sf))
    oracle_names, want = oracle_rows(oracle_connection(sf), ORACLES[name])
    assert names == oracle_names
    assert rows == want
