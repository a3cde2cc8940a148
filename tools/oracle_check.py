"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

    python tools/oracle_check.py [sf_dir] [name ...]

Compares row count, column names + types, and the multiset of row values.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from packflow.sources.tables import TABLES, table_path  # noqa: E402

_TYPE = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE",
         "StringType": "VARCHAR", "BooleanType": "BOOLEAN", "DateType": "DATE"}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def canon(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, repr(v + 0.0))
    return (1, repr(v))


def compare(spark, con, name, q, sf_dir, verbose=True):
    t0 = time.time()
    sdf = q.fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols = [(f.name, _TYPE.get(type(f.dataType).__name__, str(f.dataType))) for f in sdf.schema]
    if q.sql is None:
        return ("rows-only", len(srows), t1 - t0, 0.0, "")
    res = con.execute(q.sql)
    dcols = [(d[0], str(d[1])) for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    msg = ""
    ok = True
    if [c for c, _ in scols] != [c for c, _ in dcols]:
        ok, msg = False, f"columns {scols} vs {dcols}"
    elif [t for _, t in scols] != [t for _, t in dcols]:
        ok, msg = False, f"types {scols} vs {dcols}"
    elif len(srows) != len(drows):
        ok, msg = False, f"rows {len(srows)} vs {len(drows)}"
    else:
        a = sorted(tuple(canon(v) for v in r) for r in srows)
        b = sorted(tuple(canon(v) for v in r) for r in drows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            ok, msg = False, f"values differ, e.g. {diff}"
    return ("ok" if ok else "FAIL", len(srows), t1 - t0, t2 - t1, msg)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    from packflow.plans.catalog import REGISTRY
    from packflow.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8, driver_memory="16g")
    con = duck(sf_dir)
    fails = 0
    for name, q in REGISTRY.items():
        if names and name not in names:
            continue
        try:
            st, n, ts, td, msg = compare(spark, con, name, q, sf_dir)
        except Exception as e:  # report and continue
            st, n, ts, td, msg = "ERROR", -1, 0, 0, f"{type(e).__name__}: {str(e)[:400]}"
        fails += st in ("FAIL", "ERROR")
        print(f"{st:9s} {name:34s} rows={n:<7d} spark={ts:5.1f}s duck={td:5.1f}s {msg}", flush=True)
    print(f"failures: {fails}")
    spark.stop()
    sys.exit(1 if fails else 0)


if __name__ == "__main__":
    main()
