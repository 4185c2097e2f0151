"""Run registered queries in Spark and their oracle SQL in DuckDB and compare
row count, column names and an order-insensitive value hash.

python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, ".")

from recsignals.sources.tables import TABLES  # noqa: E402


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    pdf = pdf[cols]
    out = []
    for rec in pdf.itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names, con=None, verbose=True):
    from recsignals.plans.catalog import ORACLES, QUERIES
    con = con or duck(sf_dir)
    results = {}
    for name in names:
        t0 = time.time()
        sdf = QUERIES[name](spark, sf_dir)
        spdf = sdf.toPandas()
        t1 = time.time()
        if name not in ORACLES:
            results[name] = ("rows-only", len(spdf))
            if verbose:
                print(f"{name}: rows-only {len(spdf)} rows spark={t1-t0:.1f}s", flush=True)
            continue
        opdf = con.execute(ORACLES[name]).df()
        t2 = time.time()
        sc, sr = rows_of(spdf)
        oc, orr = rows_of(opdf)
        sk = [spdf[c].dtype.kind for c in sc]
        ok_ = [opdf[c].dtype.kind for c in oc]
        ok = sc == oc and sk == ok_ and len(sr) == len(orr) and sr == orr
        if sc == oc and sk != ok_:
            print("  dtype kinds differ:", [(c, a, b) for c, a, b in zip(sc, sk, ok_) if a != b])
        results[name] = ok
        if verbose:
            print(f"{name}: {'OK' if ok else 'MISMATCH'} rows={len(sr)}/{len(orr)} "
                  f"spark={t1-t0:.1f}s duck={t2-t1:.1f}s", flush=True)
            if not ok:
                if sc != oc:
                    print("  cols spark-only", sorted(set(sc) - set(oc)), "oracle-only", sorted(set(oc) - set(sc)))
                else:
                    diffs = [(a, b) for a, b in zip(sr, orr) if a != b][:3]
                    for a, b in diffs:
                        print("  spark ", a)
                        print("  oracle", b)
    return results


if __name__ == "__main__":
    from recsignals.session import get_spark
    from recsignals.plans.catalog import QUERIES
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = get_spark("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, names)
    bad = [n for n, v in res.items() if v is False]
    print("FAILED:", bad if bad else "none", f"({len(res)} checked)")
