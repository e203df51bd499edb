"""Run registered queries on Spark and their SQL twins on DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Columns are compared by name (sorted), rows as an order-insensitive
multiset of exact values.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from scorewatch.session import build_session  # noqa: E402
from scorewatch.sources.tables import BASE_TABLES  # noqa: E402


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
          "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "smallint": "SMALLINT",
          "float": "FLOAT"}


def type_diffs(df, res):
    spark_t = {n: _TYPES.get(t, t) for n, t in df.dtypes}
    duck_t = {d[0]: str(d[1]) for d in res.description}
    return {n: (spark_t[n], duck_t.get(n)) for n in spark_t if spark_t[n] != duck_t.get(n)}


def check(spark, con, name, fn, sql, sf_dir, verbose=True):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    scols, srows = rows_of(df.columns, srows)
    if sql is None:
        print(f"{name}: spark rows={len(srows)} ({t1 - t0:.1f}s) [no twin]")
        return True
    res = con.execute(sql)
    dcols_raw = [d[0] for d in res.description]
    dcols, drows = rows_of(dcols_raw, res.fetchall())
    ok_cols = scols == dcols
    ok = ok_cols and srows == drows
    td = type_diffs(df, res)
    if td:
        print(f"  {name}: type differences {td}")
    print(f"{name}: {'OK' if ok else 'MISMATCH'} spark={len(srows)} duck={len(drows)} ({t1 - t0:.1f}s)")
    if not ok and verbose:
        if not ok_cols:
            print("  spark cols", scols, "\n  duck cols ", dcols)
        else:
            sset, dset = set(srows), set(drows)
            for r in sorted(sset - dset, key=repr)[:5]:
                print("  only spark:", r)
            for r in sorted(dset - sset, key=repr)[:5]:
                print("  only duck: ", r)
    return ok


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, tw = queries(), oracle_sql()
    bad = []
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            if not check(spark, con, name, fn, tw.get(name), sf_dir):
                bad.append(name)
        except Exception as e:  # report and continue with the next query
            print(f"{name}: ERROR {type(e).__name__}: {str(e)[:800]}")
            bad.append(name)
    print("FAILED:", bad if bad else "none")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
