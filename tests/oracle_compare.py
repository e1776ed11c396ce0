"""Spark vs DuckDB comparison of the registered queries (the correctness gate, run locally).

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = pd.to_datetime(df[c]).astype("datetime64[us]")
    df = df.astype(object).where(pd.notnull(df), None).map(lambda v: int(v) if isinstance(v, (bool, float)) is False and hasattr(v, "__index__") else v)
    rows = sorted((tuple(repr(v) for v in r) for r in df.itertuples(index=False)))
    return rows


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s = sdf.toPandas()
    for f in sdf.schema.fields:  # whole numbers with nulls come as floats
        if f.dataType.typeName() in ("byte", "short", "integer", "long"):
            s[f.name] = s[f.name].astype("Int64")
    t1 = time.time()
    res = {"query": name, "spark_rows": len(s), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    d = con.execute(sql).df()
    res["oracle_rows"] = len(d)
    res["cols_match"] = sorted(s.columns) == sorted(d.columns)
    if not res["cols_match"]:
        res["status"] = f"COLS spark={sorted(s.columns)} duck={sorted(d.columns)}"
        return res
    rs, rd = _norm(s), _norm(d)
    if rs == rd:
        res["status"] = "MATCH"
    else:
        diff_s = [r for r in rs if r not in set(rd)][:3]
        diff_d = [r for r in rd if r not in set(rs)][:3]
        res["status"] = "MISMATCH"
        res["only_spark"] = diff_s
        res["only_duck"] = diff_d
        res["cols"] = sorted(s.columns)
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from tankflow.session import build_session
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    q, o = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in q.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, con, name, fn, o.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"query": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("MATCH", "rows-only")
        print(r, flush=True)
    print(f"done: {len(q)} queries, {bad} not matching")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
