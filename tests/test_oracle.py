"""Every registered query against its check SQL on the smallest tables."""

import pytest
from oracle import difference

import __spark_entry__ as contract
from registry import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
#: Queries that no SQL can say: none at present.
NO_SQL: set[str] = set()


def test_contract_lists_everything():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) - set(contract.oracle_sql()) == NO_SQL


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "dataset_type"
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    assert difference(spark, SF_DIR, QUERIES[name], ORACLE[name]) is None
