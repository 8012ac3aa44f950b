"""Every registered query against its SQL, on the smallest data."""

import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as entry
from corpuslake.registry import all_queries

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return connection


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cell = lambda x: round(x, 6) if isinstance(x, float) else x
    return [names[i] for i in order], Counter(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    df = QUERIES[name](spark, DATA)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    if name in SQL:
        rel = db.sql(SQL[name])
        assert got == table(rel.columns, rel.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 20


def test_every_query_has_sql():
    assert all(q.sql for q in all_queries().values())


def test_no_driver_side_collection_in_operators():
    root = Path(__file__).resolve().parents[1] / "corpuslake"
    for folder in ("operators", "functions", "sources"):
        for f in (root / folder).glob("*.py"):
            assert not re.search(r"\.(collect|toPandas|localCheckpoint|crossJoin)\(", f.read_text()), f
