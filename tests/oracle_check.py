"""Run registered Spark queries next to their DuckDB oracle and compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from corpusmill.plans.registry import REGISTRY, _load_all  # noqa: E402
from corpusmill.plans.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(rows, key=repr)


def compare(spark, sf_dir: str, name: str, con=None) -> tuple[bool, str]:
    q = REGISTRY[name]
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = q.fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if q.sql is None:
        return True, f"{name}: {len(s_rows)} rows (no oracle) spark {t1 - t0:.1f}s"
    res = con.execute(q.sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    if sc != dc:
        return False, f"{name}: columns differ spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"{name}: rows differ spark={len(sr)} duck={len(dr)}"
    if sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
        return False, f"{name}: values differ, e.g. {bad!r}"[:3000]
    return True, f"{name}: OK {len(sr)} rows, spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s"


def main(argv):
    from corpusmill.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    _load_all()
    names = argv[2:] or list(REGISTRY)
    spark = local_session()
    con = duck(sf_dir)
    failed = []
    for n in names:
        try:
            ok, msg = compare(spark, sf_dir, n, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:1500]}"
        print(msg, flush=True)
        if not ok:
            failed.append(n)
    print("FAILED:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
