"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from tests.oracle_check import compare, duck
from tests.conftest import SF_SMALL

import __spark_entry__ as entry_module

from cadence.plans.queries import registry

SF_TIED = "/root/testdata/sf0.01"

# The queries of the model; those of other subpackages have tests of their own.
QUERIES = registry()
ORACLE = {name: sql for name, sql in entry_module.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["columns_match"], r
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["values_match"], r


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("payment_sequence")))
def test_sequences_with_ties_match_on_a_larger_table(spark, name):
    """Equal payments on one day are rare in the smallest tables."""
    r = compare(spark, duck(SF_TIED), name, QUERIES[name], ORACLE[name], SF_TIED)
    assert r["columns_match"] and r["values_match"], r


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["customer_id", "kind", "calendar_date", "amount"]
    assert df.count() > 0
