"""Every named query against its SQL counterpart, row for row."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from conftest import DATA
from oracle.sql import statements
from tillroll.plans import catalog

TABLES = "region nation customer supplier part orders lineitem".split()
QUERIES = catalog.queries()
SQL = statements()
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert SQL.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, duck, plan_of, name):
    frame = QUERIES[name](spark, DATA)
    plan = plan_of(frame)
    for pairwise_or_python in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"):
        assert pairwise_or_python not in plan
    cursor = duck.execute(SQL[name])
    types = {c[0]: str(c[1]) for c in cursor.description}
    assert {c: TYPES[t] for c, t in frame.dtypes} == types
    position = [list(types).index(c) for c in frame.columns]
    expected = Counter(tuple(row[i] for i in position) for row in cursor.fetchall())
    assert Counter(tuple(row) for row in frame.collect()) == expected


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert [r["segment_label"][0] for r in rows] == list("ABCDEFGHIJK")
