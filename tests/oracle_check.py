"""Run every registered Spark query and its DuckDB oracle side by side.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Compares column names, row counts and the multiset of rows (values compared
exactly, order-insensitive), as the driver's correctness gate does.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tandem.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def canon(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        if v == int(v) and abs(v) < 2**53:
            return ("n", str(int(v)))
        return ("n", repr(v))
    if isinstance(v, bool):
        return ("b", str(v))
    if isinstance(v, int):
        return ("n", str(v))
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if hasattr(v, "item"):
        return canon(v.item())
    if hasattr(v, "to_pydatetime"):
        return canon(v.to_pydatetime())
    return ("s", str(v))


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in records)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in sqls:
            print(f"{name:34s} spark rows={len(s_rows):7d} (no oracle) {t1 - t0:6.2f}s")
            continue
        res = con.execute(sqls[name])
        d_cols = [c[0] for c in res.description]
        d_rows = res.fetchall()
        ok_cols = sorted(s_cols) == sorted(d_cols)
        ok_n = len(s_rows) == len(d_rows)
        a = rows_of(s_cols, s_rows) if ok_cols else []
        b = rows_of(d_cols, d_rows) if ok_cols else []
        ok_v = ok_cols and a == b
        status = "OK " if (ok_cols and ok_n and ok_v) else "BAD"
        bad += status == "BAD"
        print(f"{status} {name:30s} rows spark={len(s_rows):7d} duck={len(d_rows):7d} "
              f"cols={'ok' if ok_cols else 'DIFF'} values={'ok' if ok_v else 'DIFF'} {t1 - t0:6.2f}s")
        if not ok_cols:
            print("   spark only:", sorted(set(s_cols) - set(d_cols)))
            print("   duck  only:", sorted(set(d_cols) - set(s_cols)))
        elif not ok_v:
            sa, sb = set(a), set(b)
            only_s = [r for r in a if r not in sb][:3]
            only_d = [r for r in b if r not in sa][:3]
            cols = sorted(s_cols)
            for r in only_s:
                print("   spark:", dict(zip(cols, r)))
            for r in only_d:
                print("   duck :", dict(zip(cols, r)))
            if only_s and only_d:
                diff = [c for c, x, y in zip(cols, only_s[0], only_d[0]) if x != y]
                print("   first differing columns:", diff[:20])
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
