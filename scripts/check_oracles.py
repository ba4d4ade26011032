"""Run every registered query in Spark and its oracle in DuckDB; compare rows exactly.

usage: python scripts/check_oracles.py [sf_dir] [name ...]
"""
from __future__ import annotations

import sys
import time

import duckdb

sys.path.insert(0, ".")
from periodstats.plans import catalog  # noqa: E402
from periodstats.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(rows):
    return sorted(tuple("<null>" if v is None else repr(v) for v in r) for r in rows)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(catalog.REGISTRY)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = catalog.run(name, spark, sf)
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # report and go on
            bad += 1
            print(f"{name:28s} ERROR {str(e).splitlines()[0][:300]}")
            continue
        ts = time.time() - t0
        sql = catalog.oracle(name)
        if sql is None:
            print(f"{name:28s} spark={len(rows):6d} rows  (no oracle)  {ts:.1f}s")
            continue
        res = con.execute(sql)
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        same_cols = ocols == df.columns
        a, b = norm(rows), norm(orows)
        ok = same_cols and a == b
        bad += not ok
        print(f"{name:28s} spark={len(rows):6d} oracle={len(orows):6d} "
              f"{'OK' if ok else 'MISMATCH'} {ts:.1f}s")
        if not ok:
            if not same_cols:
                print("   cols", df.columns, ocols)
            sa, sb = set(a), set(b)
            for r in list(sa - sb)[:3]:
                print("   spark only ", r)
            for r in list(sb - sa)[:3]:
                print("   oracle only", r)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
