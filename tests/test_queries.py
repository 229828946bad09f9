"""Every registered query beside its SQL oracle."""

import duckdb
import pytest
from conftest import rows  # noqa: F401

import __spark_entry__ as contract
from tools.check_oracles import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry(spark):
    assert set(contract.entry(spark).columns) == {"l_orderkey", "l_extendedprice", "l_quantity"}
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, oracle, name):
    df = contract.queries()[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    sql = contract.oracle_sql().get(name)
    if sql is not None:
        result = oracle.execute(sql)
        columns = [c[0] for c in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == rows_of(columns, result.fetchall())
