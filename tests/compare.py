"""Run queries beside their SQL checks in DuckDB.

    python tests/compare.py SF [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from fieldcast.bindings import BASE  # noqa: E402

TESTDATA = "/root/testdata"


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool):
        return str(value)
    return "" if value is None else f"{type(value).__name__}:{value}"


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(con, df, sql: str) -> str | None:
    """None if both sides give the same columns and rows, else what differs."""
    found = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    wanted = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    left, right = _rows(df.columns, found), _rows(names, wanted)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            pairs = [(c, x, y) for c, x, y in zip(sorted(names), a, b) if x != y]
            return f"first differing row: {pairs} in {a}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from fieldcast.session import build_session

    sf_dir = f"{TESTDATA}/sf{sys.argv[1]}"
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    checks, bad = oracle_sql(), []
    for name, build in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        begin = time.time()
        try:
            df = build(spark, sf_dir)
            problem = difference(con, df, checks[name]) if name in checks else f"no check, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"ERROR {str(error)[:500]}"
        if problem:
            bad.append(name)
        print(f"{name:38s} {time.time() - begin:6.1f}s {problem or 'ok'}", flush=True)
    print(f"{len(bad)} not ok: {bad}")


if __name__ == "__main__":
    main()
