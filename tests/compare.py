"""Runs catalogue queries beside their SQL and reports differences.

``python -m tests.compare SF_DIR [name ...]``
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return repr(v + 0.0) if isinstance(v, float) else repr(v)


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(plain(r[i])) for i in order) for r in data)


def differences(spark, con, sf_dir, fn, sql):
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} against {sorted(rel.columns)}", len(got)
    if got == want:
        return None, len(got)
    a, b = [r for r in got if r not in set(want)], [r for r in want if r not in set(got)]
    return f"{len(got)} rows against {len(want)}; ours {a[:3]}, theirs {b[:3]} ({len(a)}/{len(b)})", len(got)


def main():
    from tests.conftest import make_session
    from workload.oracle import ORACLE
    from workload.queries import QUERIES

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con, bad = make_session(), duck(sf_dir), 0
    for n in names:
        t = time.time()
        try:
            diff, rows = differences(spark, con, sf_dir, QUERIES[n], ORACLE[n])
        except Exception as e:  # report and go on
            diff, rows = f"{type(e).__name__}: {str(e)[:600]}", 0
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {n} rows={rows} sec={time.time() - t:.1f} {diff or ''}", flush=True)
    print("missing sql:", sorted(set(QUERIES) - set(ORACLE)), "missing query:", sorted(set(ORACLE) - set(QUERIES)), "bad:", bad)


if __name__ == "__main__":
    main()
