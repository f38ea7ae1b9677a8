"""Every registered query against its SQL in another engine, on the smallest tables."""

import datetime as dt
import glob
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL
from tapework.plans.catalog import QUERIES
from tapework.plans.oracle import ORACLES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    return value.date() if isinstance(value, dt.datetime) else value


def rows_of(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sql, name):
    result = QUERIES[name](spark, SMALL)
    cursor = sql.execute(ORACLES[name])
    described = {c[0]: str(c[1]) for c in cursor.description}
    assert {c: TYPES[t] for c, t in result.dtypes} == described
    assert rows_of(result.columns, result.collect()) == rows_of(list(described), cursor.fetchall())
