"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from lendreach.checks import all_queries
from lendreach.checks.verify import compare, connect

SF = "/root/testdata/sf0.001"
NAMES = sorted(all_queries().QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_contract_names_match():
    assert set(all_queries().ORACLES) == set(NAMES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows_or_schema(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["business_date", "list_module"] and df.count() >= 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    ok, _, why = compare(spark, con, contract.queries()[name], contract.oracle_sql()[name], SF)
    assert ok, why
