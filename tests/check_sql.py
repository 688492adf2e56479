"""Run the registered queries next to their SQL: `python tests/check_sql.py [name ...]`."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, decimal.Decimal):  # exact sums of whole numbers
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return dt.datetime(value.year, value.month, value.day)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(table, key=lambda r: tuple((v is not None, str(v)) for v in r))


def compare(df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    mine = canonical(df.columns, df.collect())
    cur = con.execute(sql)
    theirs = canonical([d[0] for d in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} vs {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} vs {len(theirs[1])}"
    bad = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    return f"{len(bad)} rows differ, first {str(bad[0])[:600]}" if bad else None


def main(names: list[str]) -> int:
    import __spark_entry__ as e
    from revlens.session import session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name, fn in e.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            sql = e.oracle_sql().get(name)
            if sql is None:
                rows = fn(spark, folder).collect()
                result = f"rows only, {len(rows)}: {str(rows[:2])[:300]}"
            else:
                result = compare(fn(spark, folder), con, sql)
                failed += result is not None
        except Exception as error:  # report and go on with the next query
            failed += 1
            result = f"ERROR {type(error).__name__}: {str(error)[:700]}"
        print(f"{name:34s} {time.time() - begin:6.2f}s  {result or 'ok'}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
