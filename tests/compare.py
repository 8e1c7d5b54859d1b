"""Run registered queries and their SQL on the same tables and compare."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "∅" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, bool):
        return str(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    """None when equal, else a short description; also the two times."""
    start = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    took = time.time() - start
    if sql is None:
        return None, took, len(got)
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    expected = want.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", took, len(got)
    a, b = rows_of(df.columns, got), rows_of(names, expected)
    if a == b:
        return None, took, len(got)
    only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return f"{len(a)} rows vs {len(b)}; spark only {only_a}; sql only {only_b}", took, len(got)


def main(sf_dir: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from codeweft.session import build

    spark = build("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                  spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    sqls = oracle_sql()
    for name, fn in queries().items():
        if names and name not in names:
            continue
        try:
            problem, took, count = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            problem, took, count = f"{type(error).__name__}: {str(error).split("JVM stacktrace")[0][:600]}", 0, 0
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:28} {took:6.1f}s {count:8} rows {'' if name in sqls else '(no sql)'} {problem or ''}", flush=True)
    print("bad", bad)
    return bad


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
