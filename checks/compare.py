"""Run registered queries next to their oracles: ``python -m checks.compare [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v if isinstance(v, (int, str)) else float(v) if isinstance(v, float) or hasattr(v, "__float__") else str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, fn, sql: str) -> tuple[str, int]:
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = rows_of(names, res.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got)
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return (f"{len(bad)} rows differ, e.g. {bad[0]}" if bad else "ok"), len(got)


def main(argv: list[str]) -> int:
    from cellframe.session import local_session
    from checks import ORACLES, QUERIES

    sf_dir = f"/root/testdata/sf{argv[0]}" if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = local_session("8")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                verdict, n = compare(spark, con, sf_dir, QUERIES[name], ORACLES[name])
            else:
                n = len(QUERIES[name](spark, sf_dir).collect())
                verdict = "rows only"
        except Exception as e:  # report and go on with the next query
            verdict, n = f"ERROR {type(e).__name__}: {str(e)[:600]}", -1
        failed += verdict not in ("ok", "rows only")
        print(f"{name:32s} {n:8d} {time.time() - start:7.2f}s  {verdict}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
