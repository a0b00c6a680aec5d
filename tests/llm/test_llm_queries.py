"""The registered queries of the subpackage that have SQL give DuckDB's rows."""

import duckdb
import pytest

from galley.llm.queries import oracle_sql, queries

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    df = queries()[name](spark, "/root/testdata/sf0.001")
    want = db.execute(oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(df.select(columns).collect()) == sorted(want.fetchall())
