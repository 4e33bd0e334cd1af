"""Run registered Spark queries next to their DuckDB oracle SQL and compare.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]

Compares row counts, column names (sorted) and an order-insensitive multiset of
normalised rows (floats rounded to 9 significant digits, lists as tuples).
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, key: str, sf_dir: str, queries: dict, oracles: dict) -> dict:
    t0 = time.time()
    sdf = queries[key](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = list(sdf.columns)
    t1 = time.time()
    res = {"key": key, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if key not in oracles:
        res["status"] = "no-oracle"
        return res
    cur = con.execute(oracles[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res["oracle_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"COLUMNS {sorted(scols)} vs {sorted(dcols)}"
        return res
    a, b = _rows(scols, srows), _rows(dcols, drows)
    if a == b:
        res["status"] = "ok"
    else:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res["status"] = f"VALUES spark-only {diff_a} oracle-only {diff_b}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from peakflow.plans.registry import all_oracles, all_queries
    from peakflow.session import local_session
    spark = local_session(8)
    con = duck(sf_dir)
    q, o = all_queries(), all_oracles()
    bad = 0
    for k in keys or list(q):
        try:
            r = compare(spark, con, k, sf_dir, q, o)
        except Exception as e:  # noqa: BLE001
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        ok = r["status"] in ("ok", "no-oracle")
        bad += not ok
        print(("  " if ok else "!!"), r, flush=True)
    print(f"{len(keys or q) - bad} ok / {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
