"""Run registered Spark queries and their DuckDB oracle side by side.

Comparison is strict: same column names, same row count, same multiset of
rows (values compared exactly after normalising Python types).

    python tests/oracle_harness.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from lienlake.sources.tables import DRIVER_TABLES, table_path  # noqa: E402


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return [cols[i] for i in order], out


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return {"key": key, "status": "rows-only", "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = [tuple(r) for r in res.fetchall()]
    t2 = time.time()
    sc, sr = canon(scols, srows)
    dc, dr = canon(dcols, drows)
    info = {"key": key, "rows": len(srows), "oracle_rows": len(drows),
            "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if sc != dc:
        info.update(status="SCHEMA", spark_cols=sc, oracle_cols=dc)
    elif len(sr) != len(dr):
        info.update(status="ROWCOUNT")
    elif sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        info.update(status="VALUES", first_diffs=bad)
    else:
        info.update(status="OK")
    return info


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from lienlake.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = build_session("local[8]", 8)
    con = duck_connect(sf_dir)
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for k in (keys or sorted(qs)):
        try:
            info = compare(spark, con, k, qs[k], os_.get(k), sf_dir)
        except Exception as e:  # report and continue
            info = {"key": k, "status": "ERROR", "error": repr(e)[:800]}
        if info["status"] not in ("OK", "rows-only"):
            bad += 1
        print(info, flush=True)
    print(f"done: {len(keys or qs)} keys, {bad} failing")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
