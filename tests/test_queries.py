"""Every registered query against its SQL on the smallest tables."""

import decimal
from pathlib import Path

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")

FOLDER = Path("/root/testdata/sf0.001")
NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are absent")

QUERIES, SQL = entry.table_queries.QUERIES, entry.table_queries.SQL


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    return float(value) if isinstance(value, decimal.Decimal) else value


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_all_have_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, database, name):
    df = QUERIES[name](spark, str(FOLDER))
    columns = sorted(df.columns)
    found = [tuple(plain(row[c]) for c in columns) for row in df.collect()]
    cursor = database.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    expected = [tuple(plain(row[i]) for i in at) for row in cursor.fetchall()]
    assert ordered(found) == ordered(expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
