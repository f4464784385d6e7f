import pytest

import __spark_entry__
from cadence.llm import queries
from tests.oracle_check import compare, duck

SMALL = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    names = __spark_entry__.queries()
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in names and set(queries.QUERIES) <= set(names)
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    result = compare(spark, duck(SMALL), name, queries.QUERIES[name], queries.ORACLE_SQL[name], SMALL)
    assert result["columns_match"] and result["values_match"], result
