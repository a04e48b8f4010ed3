"""Every registered query against its SQL on the shared tables."""

import pytest
from compare import assert_same, connect

import __spark_entry__ as contract
from tableloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, folder, con, name):
    result = contract.queries()[name](spark, folder)
    assert_same(result, con, contract.oracle_sql()[name])


def test_every_query_has_sql():
    assert {name for name in QUERIES if name not in contract.oracle_sql()} == set()
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["c_custkey", "c_name", "n_name", "total_amount"]
    assert result.count() > 0


def test_inventory_lists_every_table(spark, folder):
    result = contract.queries()["file_inventory"](spark, folder).collect()
    assert len(result) == 14
    assert all(row.extension == ".parquet" and row.n_rows > 0 for row in result)
