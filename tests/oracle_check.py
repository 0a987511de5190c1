"""Run registered queries and their DuckDB oracles side by side.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: status, rows, seconds. Used by tests and by hand.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from insight.sources.tables import TABLE_NAMES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 5)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    ts = time.time() - t0
    if sql is None:
        return "ROWS", len(srows), ts, ""
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return "COLS", len(srows), ts, f"spark={sorted(scols)} duck={sorted(dcols)}"
    if len(srows) != len(drows):
        return "NROWS", len(srows), ts, f"spark={len(srows)} duck={len(drows)}"
    a, b = _rows(scols, srows), _rows(dcols, drows)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return "VALUES", len(srows), ts, f"{len(bad)} differ, e.g. {bad[0]}"
    return "OK", len(srows), ts, ""


def main():
    from insight.plans.registry import ORACLES, QUERIES, load_all
    from insight.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    load_all()
    spark = build_session()
    con = duck(sf_dir)
    failed = 0
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        try:
            status, n, ts, msg = compare(spark, con, name, fn, ORACLES.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            status, n, ts, msg = "ERROR", -1, 0.0, repr(e)[:300]
        failed += status not in ("OK", "ROWS")
        print(f"{status:7s} {name:24s} rows={n:<7d} {ts:6.2f}s {msg}", flush=True)
    print(f"failed={failed}")


if __name__ == "__main__":
    main()
