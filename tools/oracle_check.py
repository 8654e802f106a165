"""Run registered queries in Spark and their SQL in DuckDB; compare the results.

Usage: python tools/oracle_check.py [sf_dir] [name ...]

Mirrors the driver's check: same column names, same row count, and the same
multiset of rows (order-insensitive; floats compared after rounding to 9
significant digits).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quarry.plans.catalog import ORACLE, QUERIES  # noqa: E402
from quarry.session import get_session  # noqa: E402
from quarry.sources.tables import TABLE_NAMES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in t))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if name not in ORACLE:
        return True, f"rows-only: {len(srows)} rows ({t1 - t0:.1f}s)"
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return False, f"row count spark={len(srows)} duck={len(drows)}"
    a, b = _rows(scols, srows), _rows(dcols, drows)
    if a != b:
        for x, y in zip(a, b):
            if x != y:
                return False, f"value mismatch (sorted cols {sorted(scols)}): spark={x} duck={y}"
    return True, f"{len(srows)} rows ({t1 - t0:.1f}s)"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = get_session("local[8]", conf={"spark.ui.showConsoleProgress": "false"})
    con = duck(sf_dir)
    bad = 0
    for name in names:
        try:
            ok, msg = check(spark, con, name, sf_dir)
        except Exception as exc:  # report and continue with the next query
            ok, msg = False, f"error: {type(exc).__name__}: {str(exc)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name}: {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
