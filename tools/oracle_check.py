"""Run registered queries in Spark and their SQL in DuckDB; compare rows, columns, values.

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [--plain] [name ...]

``--plain`` uses a default SparkSession (default shuffle partitions, no checkpoint folder
configured) instead of the tuned test session.  Values are compared as an
order-insensitive hash over rows with columns sorted by name.
"""

from __future__ import annotations

import argparse
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.session import build_session  # noqa: E402
from tessera.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return cols, out


def _digest(rows):
    h = hashlib.sha256()
    for r in sorted(repr(x) for x in rows):
        h.update(r.encode())
    return h.hexdigest()[:16]


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--plain", action="store_true",
                    help="use a default SparkSession (no tuned settings, no checkpoint dir)")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    import importlib.util
    spec = importlib.util.spec_from_file_location(
        "spark_entry", os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                    "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    queries, sqls = entry.queries(), entry.oracle_sql()
    names = args.names or list(queries)
    if args.plain:
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session(shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            sdf = queries[name](spark, args.sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: spark rows={len(sdf)} ({ts:.1f}s) [no oracle]")
            continue
        t1 = time.time()
        try:
            odf = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        to = time.time() - t1
        sc, sr = _rows(sdf)
        oc, orows = _rows(odf)
        ok = sc == oc and len(sr) == len(orows) and _digest(sr) == _digest(orows)
        status = "OK  " if ok else "DIFF"
        print(f"{status} {name}: rows spark={len(sr)} oracle={len(orows)} "
              f"({ts:.1f}s / {to:.1f}s)")
        if not ok:
            bad += 1
            if sc != oc:
                print("   columns", sc, oc)
            else:
                s1, s2 = set(sr), set(orows)
                print("   only spark:", sorted(s1 - s2, key=repr)[:3])
                print("   only oracle:", sorted(s2 - s1, key=repr)[:3])
            print("   spark dtypes", dict(sdf.dtypes.astype(str)))
            print("   oracle dtypes", dict(odf.dtypes.astype(str)))
    print(f"done: {len(names) - bad}/{len(names)} ok")
    spark.stop()


if __name__ == "__main__":
    main()
