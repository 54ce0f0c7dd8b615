"""Run every check query beside its SQL twin: ``python tests/verify_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "\0null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return repr(float(v))
    return str(v)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf_dir):
    """Empty text when both sides agree, else what differs."""
    df = query(spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = canonical(rel.columns, rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} / {len(want[1])}"
    if not want[1]:
        return "no rows"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else ""


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from ridgepole.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    session, duck = local_session(8), connect(sf)
    failed = 0
    for key, fn in queries().items():
        if only and key not in only:
            continue
        began = time.time()
        try:
            problem = compare(session, duck, fn, oracle_sql()[key], sf)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {key} {time.time() - began:.2f}s {problem}", flush=True)
    print(f"{failed} failed")
