"""Run registered queries on Spark and on an SQL engine in the same process and compare the results."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted([tuple(plain(r[i]) for i in order) for r in data], key=repr)


def compare(spark, con, fn, sql, sf_dir):
    """None when equal, else a short description of the first difference."""
    df = fn(spark, sf_dir)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    theirs = rows([d[0] for d in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {set(mine[0]) ^ set(theirs[0])}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            diffs = [(n, x, y) for n, x, y in zip(mine[0], a, b) if x != y or type(x) is not type(y)]
            if [d for d in diffs if d[1] != d[2]]:
                return f"values {diffs[:4]}"
    return None


def main(argv):
    import os
    import sys
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from billproof.session import build_session

    sf_dir = argv[0]
    wanted = argv[1:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                result = compare(spark, con, fn, oracles[name], sf_dir)
            else:
                result = None if fn(spark, sf_dir).count() >= 0 else "no rows"
        except Exception as exc:
            result = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += result is not None
        empty = ""
        if result is None and name in oracles and not con.execute(oracles[name]).fetchall():
            empty = " EMPTY"
        print(f"{'ok  ' if result is None else 'FAIL'} {time.time() - start:5.1f}s {name}{empty} {result or ''}", flush=True)
    print("failures", bad)
    spark.stop()


if __name__ == "__main__":
    import sys

    main(sys.argv[1:])
