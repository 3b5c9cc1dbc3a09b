"""Run queries next to their SQL and compare rows.

    python tests/compare.py [sf-dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        number = float(value)
        return (2, "nan" if math.isnan(number) else repr(number))
    return (3, str(value))


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def expected(con, sql: str):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return columns, result.fetchall()


def difference(con, spark, sf: str, function, sql: str | None) -> tuple[str | None, int, float]:
    """(message or None, rows, seconds)."""
    start = time.time()
    frame = function(spark, sf)
    rows = [tuple(r) for r in frame.collect()]
    seconds = time.time() - start
    if sql is None:
        return None, len(rows), seconds
    columns, wanted = expected(con, sql)
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}", len(rows), seconds
    got, want = normal(frame.columns, rows), normal(columns, wanted)
    if got == want:
        return None, len(rows), seconds
    extra = [r for r in got if r not in set(want)][:2]
    missing = [r for r in want if r not in set(got)][:2]
    return f"rows {len(got)} vs {len(want)}; extra {extra}; missing {missing}", len(rows), seconds


if __name__ == "__main__":
    import __spark_entry__ as entry
    from caudal.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session(
        "compare", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    sql = entry.oracle_sql()
    failed = 0
    for name, function in entry.queries().items():
        if names and name not in names:
            continue
        try:
            message, rows, seconds = difference(con, spark, sf, function, sql.get(name))
        except Exception as error:  # report and go on
            message, rows, seconds = f"{type(error).__name__}: {str(error)[:600]}", 0, 0.0
        failed += message is not None
        print(f"{'FAIL' if message else 'ok  '} {name:28} {rows:8} rows {seconds:6.2f}s {message or ''}", flush=True)
    print("failed:", failed)
    sys.exit(1 if failed else 0)
