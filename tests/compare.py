"""Run named queries and their SQL side by side: python tests/compare.py SF [name ...]."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


KINDS = {"boolean": "BOOLEAN", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: [str(v) for v in r])


def check(spark, connection, name, query, sql, folder) -> str:
    """Empty when both sides agree, else what differs."""
    result = query(spark, folder)
    left = sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    if sql is None:
        return "" if left[1] else "no rows"
    cursor = connection.execute(sql)
    right = sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows != {len(right[1])}"
    differing = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if differing:
        return f"{len(differing)} of {len(left[1])} rows differ, first {differing[0]}"
    types = {d[0]: str(d[1]) for d in cursor.description}
    odd = {c: (t, types[c]) for c, t in result.dtypes if KINDS.get(t) != types[c]}
    return f"types {odd}" if odd else ""


def main() -> None:
    import __spark_entry__ as entry
    from barlab.session import open_session

    folder = f"/root/testdata/sf{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = open_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = duck(folder), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            problem = check(spark, connection, name, query, sql.get(name), folder)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        kind = "sql" if name in sql else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {name:28} {kind:4} {time.time() - started:6.2f}s {problem}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
