"""The corpus queries that SQL can express, against DuckDB on the same tables."""

import datetime
import decimal

import duckdb
import pytest

from echoloom.llm.queries import ORACLES, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


def cell(v):
    return f"{float(v):.7g}" if isinstance(v, (float, decimal.Decimal)) else v.isoformat() if isinstance(v, datetime.datetime) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = QUERIES[name](spark, small)
    order = sorted(df.columns)
    out = con.execute(ORACLES[name])
    columns = [c[0] for c in out.description]
    assert sorted(columns) == order
    at = [columns.index(c) for c in order]
    assert sorted(tuple(cell(r[c]) for c in order) for r in df.collect()) == sorted(tuple(cell(r[i]) for i in at) for r in out.fetchall())
