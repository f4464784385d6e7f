"""Run registered queries in Spark and their oracle SQL in DuckDB and compare.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float) and v != v:
        return "NaN"
    return v


def compare(spark, con, name: str, build, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = build(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    idx = [d_cols.index(c) for c in sorted(d_cols)]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in d_rows]
    t2 = time.time()
    result = {
        "name": name,
        "rows_spark": len(s_rows), "rows_oracle": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "values_match": Counter(s_rows) == Counter(d_rows),
        "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2),
    }
    if not result["values_match"]:
        cs, cd = Counter(s_rows), Counter(d_rows)
        result["only_spark"] = list((cs - cd).elements())[:5]
        result["only_oracle"] = list((cd - cs).elements())[:5]
        result["columns"] = sorted(s_cols), sorted(d_cols)
    return result


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from cadence.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name}: no oracle")
            continue
        r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        ok = r["columns_match"] and r["values_match"] and r["rows_spark"] == r["rows_oracle"]
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{bad} mismatches")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
