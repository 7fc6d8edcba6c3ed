"""Compare registered Spark queries with their DuckDB oracle SQL.

Mimics the driver's check: row count, column names, order-insensitive values.
Usage: python -m tests.oracle_compare [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


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
            return None
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None).isoformat()
    if hasattr(v, "isoformat"):
        try:
            return v.replace(tzinfo=None).isoformat()
        except TypeError:
            return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    try:
        import numpy as np
        if isinstance(v, np.generic):
            return _norm(v.item())
    except Exception:
        pass
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    ok_cols = sorted(scols) == sorted(dcols)
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    ok = ok_cols and a == b
    detail = ""
    if not ok:
        if not ok_cols:
            detail = f"cols spark={sorted(scols)} oracle={sorted(dcols)}"
        else:
            sa, sb = set(a), set(b)
            detail = (f"rows spark={len(a)} oracle={len(b)}; only spark: {list(sa - sb)[:3]}; "
                      f"only oracle: {list(sb - sa)[:3]}")
    return ok, len(srows), len(drows), t1 - t0, detail


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from lodestone.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        if name not in oracle:
            df = qs[name](spark, sf_dir)
            n = df.count()
            print(f"{name:24s} rows-only   rows={n}")
            continue
        try:
            ok, ns, nd, sec, detail = compare(spark, con, name, qs[name], oracle[name], sf_dir)
        except Exception as e:  # report and go on
            ok, ns, nd, sec, detail = False, -1, -1, 0.0, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{name:24s} {'OK ' if ok else 'BAD'} spark={ns} oracle={nd} {sec:.2f}s {detail}")
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
