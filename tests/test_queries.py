"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from galley.plans.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def plain(v):
    return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


def rows(found, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, db, name):
    df = QUERIES[name](spark, DIR)
    want = db.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.collect(), df.columns) == rows(want.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())
