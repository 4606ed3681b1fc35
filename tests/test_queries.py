"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from pagetables.plans.registry import QUERIES as PLANS

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return value if value is None else str(value)


def test_every_query_has_sql():
    assert set(PLANS) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, tables, name):
    frame = QUERIES[name](spark, SF_DIR)
    names = sorted(frame.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in frame.collect()), key=str)
    relation = tables.sql(ORACLES[name])
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: SQL_TYPES[t] for c, t in frame.dtypes} == types
    order = [relation.columns.index(c) for c in names]
    want = sorted((tuple(plain(r[i]) for i in order) for r in relation.fetchall()), key=str)
    assert len(got) == len(want) and got == want


def test_entry(spark):
    assert contract.entry(spark).columns == ["l_orderkey", "name", "value"]
