"""Registered queries over the smallest tables: SQL where there is some, row counts and columns where not."""

import glob
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL
from tapework.llm.catalog import ORACLES, QUERIES


def rows_of(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    result, cursor = QUERIES[name](spark, SMALL), con.execute(ORACLES[name])
    assert rows_of(result.columns, result.collect()) == rows_of([c[0] for c in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", ["op2_quality", "op7_packing", "op9_mixing"])
def test_query_has_every_document(spark, name):
    ids = sorted(r[0] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect())
    assert sorted(r[0] for r in QUERIES[name](spark, SMALL).select("doc_id").collect()) == ids
