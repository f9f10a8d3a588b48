"""Run a query and its SQL side by side. Usable as a script: ``python tests/compare.py [sf_dir] [names...]``."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, (Decimal, int, float)) and not isinstance(value, bool):
        number = float(value)
        return None if math.isnan(number) else number
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql) -> str | None:
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    got_cols, got = rows_of(df.columns, df.collect())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries
    from marketlake.session import get_session

    args = sys.argv[1:] or ["/root/testdata/sf0.01"]
    spark = get_session(
        master="local[8]",
        conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
              "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(args[0]), oracle_sql()
    for name, query in queries().items():
        if args[1:] and name not in args[1:]:
            continue
        start = time.time()
        try:
            df = query(spark, args[0])
            result = difference(df, con, sqls[name]) if name in sqls else f"rows only: {df.count()}"
        except Exception as error:  # a script that reports every query
            result = f"{type(error).__name__} {str(error)[:600]}"
        print(f"{name:28s} {'ok' if result is None else result}  {time.time() - start:.2f}s", flush=True)
