"""Run registered queries and compare each with its SQL equivalent.

usage: python tools/check_queries.py [--sf DIR] [--rows-only] [name ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from rosterline.plans import ORACLE, QUERIES  # noqa: E402
from rosterline.session import build_session  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


KIND = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
        "array<double>": "DOUBLE[]", "array<bigint>": "BIGINT[]"}


def order_key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
        return True
    if isinstance(a, float) and isinstance(b, float):
        return a == b
    return a == b


def compare(spark_df, rel) -> str:
    cols = sorted(spark_df.columns)
    if cols != sorted(rel.columns):
        return f"columns differ: {cols} vs {sorted(rel.columns)}"
    types = dict(spark_df.dtypes)
    duck = dict(zip(rel.columns, map(str, rel.types)))
    bad = [(c, types[c], duck[c]) for c in cols if KIND.get(types[c], types[c]) != duck[c]]
    pick = [rel.columns.index(c) for c in cols]
    left = sorted((tuple(r[c] for c in cols) for r in spark_df.select(*[f"`{c}`" for c in cols]).collect()), key=order_key)
    right = sorted((tuple(r[i] for i in pick) for r in rel.fetchall()), key=order_key)
    if len(left) != len(right):
        return f"rows differ: {len(left)} vs {len(right)}"
    diffs = [(a, b) for a, b in zip(left, right) if not all(map(same, a, b))]
    if diffs:
        a, b = diffs[0]
        where = [(c, x, y) for c, x, y in zip(cols, a, b) if not same(x, y)]
        return f"{len(diffs)} of {len(left)} rows differ, first: {where[:4]} in {a[:6]}"
    if bad:
        return f"types differ: {bad}"
    return f"ok {len(left)} rows"


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--rows-only", action="store_true")
    ap.add_argument("--sql-only", action="store_true")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    failed = 0
    for name in args.names or QUERIES:
        if (args.rows_only and name in ORACLE) or (args.sql_only and name not in ORACLE):
            continue
        start = time.time()
        try:
            df = QUERIES[name](spark, args.sf)
            if name in ORACLE:
                verdict = compare(df, con.sql(ORACLE[name]))
            else:
                rows = df.collect()
                verdict = f"ok {len(rows)} rows (rows only) {rows[0] if rows else ''}"[:260]
        except Exception as e:  # report and go on
            verdict = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        spark.catalog.clearCache()
        failed += not verdict.startswith("ok")
        print(f"{'' if verdict.startswith('ok') else '!! '}{name}: {verdict} [{time.time() - start:.1f}s]", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
