"""Queries with SQL checks, side by side on the smallest tables."""

from collections import Counter

import duckdb
import pytest

from fieldcast.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    assert Counter(tuple(r[c] for c in columns) for r in frame.collect()) == Counter(expected)
