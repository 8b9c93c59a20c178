"""Run queries beside their SQL and compare rows. ``python tests/compare.py [folder] [names…]``"""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, Decimal):
        return str(value.normalize() if value == 0 else value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(_cell(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is not None, str(v)) for v in r))


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def difference(left, right) -> str | None:
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if left[1] != right[1]:
        a, b = set(map(str, left[1])), set(map(str, right[1]))
        return (f"{len(left[1])} / {len(right[1])} rows; only spark {sorted(a - b)[:3]}; "
                f"only sql {sorted(b - a)[:3]}")
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tidemill.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark, con = build_session(), database(folder)
    sql = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            got = spark_rows(run(spark, folder))
            took = time.time() - start
            diff = difference(got, sql_rows(con, sql[name])) if name in sql else "no sql"
        except Exception as error:  # report and go on
            took, diff = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
            got = ([], [])
        bad += diff is not None
        print(f"{name:28s} {len(got[1]):8d} rows {took:6.1f} s  {diff or 'ok'}", flush=True)
    print("differences:", bad)
