"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)   # exact: the driver hashes values as they are
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    return repr(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            t1 = time.time()
            if name not in sqls:
                results[name] = ("rows-only", len(srows), None, t1 - t0)
            else:
                rel = con.sql(sqls[name])
                dcols = rel.columns
                drows = rel.fetchall()
                ok_cols = sorted(scols) == sorted(dcols)
                ok = ok_cols and canon(scols, srows) == canon(dcols, drows)
                status = "OK" if ok else ("COLS" if not ok_cols else "VALUES")
                results[name] = (status, len(srows), len(drows), t1 - t0)
                if not ok and verbose:
                    print(f"  {name}: spark cols {scols}\n  duck cols {dcols}")
                    a, b = canon(scols, srows), canon(dcols, drows)
                    sa, sb = set(a), set(b)
                    print("  only spark:", list(sa - sb)[:3])
                    print("  only duck: ", list(sb - sa)[:3])
        except Exception as e:  # report and continue
            results[name] = ("ERROR", repr(e)[:300], None, time.time() - t0)
        if verbose:
            print(name, results[name], flush=True)
    return results


if __name__ == "__main__":
    from shopflow.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session()
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "rows-only")}
    print("SUMMARY", len(res), "queries;", len(bad), "not OK:", sorted(bad))
