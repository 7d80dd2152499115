"""Run every registered query on Spark and its oracle SQL on DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names (sorted), and an order-insensitive hash of
the exact values (both sides already round computed doubles to 6 decimals
in the query itself).  Prints one line per query.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0          # -0.0 and 0.0 hash alike
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from pyspark.sql import SparkSession
    import __spark_entry__ as entry
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    qs, osql = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:300]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in osql:
            print(f"rows-only {name}: {len(srows)} rows ({t1 - t0:.1f}s)")
            continue
        try:
            res = con.execute(osql[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        ok_cols = sorted(scols) == sorted(ocols)
        hs, ls = digest(scols, srows)
        ho, lo = digest(ocols, orows)
        ok = ok_cols and len(srows) == len(orows) and hs == ho
        if not ok:
            bad += 1
            print(f"FAIL {name}: rows {len(srows)} vs {len(orows)} cols_ok={ok_cols}")
            if not ok_cols:
                print("   spark-only", sorted(set(scols) - set(ocols)), "oracle-only", sorted(set(ocols) - set(scols)))
            else:
                a, b = set(ls), set(lo)
                print("   sorted cols", sorted(scols))
                for x in sorted(a - b)[:3]:
                    print("   spark :", x[:400])
                for x in sorted(b - a)[:3]:
                    print("   oracle:", x[:400])
        else:
            print(f"ok   {name}: {len(srows)} rows ({t1 - t0:.1f}s)")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
