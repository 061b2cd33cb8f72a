"""Run every registered query against its DuckDB twin and compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: name, rows (spark / duckdb), match.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{_norm(k)}:{_norm(x)}" for k, x in sorted(v.items(), key=lambda kv: repr(kv[0]))) + "}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def digest(columns, rows) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None):
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = []
    for name in names or sorted(qs):
        t = time.time()
        df = qs[name](spark, sf_dir)
        s_rows = [tuple(r) for r in df.collect()]
        s_cols = df.columns
        elapsed = time.time() - t
        if name not in sql:
            out.append((name, len(s_rows), None, None, elapsed))
            continue
        res = con.execute(sql[name])
        d_cols = [c[0] for c in res.description]
        d_rows = res.fetchall()
        ok = (sorted(s_cols) == sorted(d_cols) and len(s_rows) == len(d_rows)
              and digest(s_cols, s_rows) == digest(d_cols, d_rows))
        out.append((name, len(s_rows), len(d_rows), ok, elapsed))
    return out


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.bindAddress", "127.0.0.1").config("spark.driver.host", "127.0.0.1")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    for name, ns, nd, ok, el in compare(spark, sf_dir, sys.argv[2:] or None):
        print(f"{name:40s} spark={ns:7d} duck={nd!s:>7s} match={ok!s:5s} {el:6.2f}s", flush=True)
