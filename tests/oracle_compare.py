"""Run queries() against oracle_sql() the way the driver does:
row count, column names and an order-insensitive value hash."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, int):
        return f"{float(v):.6f}"
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, verbose=False):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from skyfare.plans.registry import QUERIES
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or QUERIES:
        t = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK_ERROR", repr(e)[:300])
            continue
        ts = time.time() - t
        if name not in sqls:
            results[name] = ("NO_ORACLE", len(rows), round(ts, 2))
            continue
        try:
            cur = con.execute(sqls[name])
            ocols = [c[0] for c in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("SQL_ERROR", repr(e)[:300])
            continue
        h1, l1 = digest(cols, rows)
        h2, l2 = digest(ocols, orows)
        ok = (sorted(cols) == sorted(ocols)) and len(rows) == len(orows) and h1 == h2
        results[name] = ("OK" if ok else "MISMATCH", len(rows), len(orows), round(ts, 2))
        if not ok and verbose:
            print(name, sorted(cols), sorted(ocols))
            a, b = set(l1), set(l2)
            print("  spark-only:", sorted(a - b)[:3])
            print("  oracle-only:", sorted(b - a)[:3])
    return results


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from skyfare.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2].split(",") if len(sys.argv) > 2 and sys.argv[2] else None
    spark = build_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names, verbose=True)
    bad = 0
    for k, v in res.items():
        print(f"{k:32s} {v}")
        bad += v[0] not in ("OK", "NO_ORACLE")
    print("failures:", bad, "of", len(res))
