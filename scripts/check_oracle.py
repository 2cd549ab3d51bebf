"""Run catalog queries in Spark and their SQL oracles in DuckDB; compare
column names, row counts and the multiset of normalized rows.

    python scripts/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensorflow.plans import catalog  # noqa: E402
from sensorflow.plans.feeds import TABLES  # noqa: E402
from sensorflow.session import build_session  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or list(catalog.QUERIES)
    spark = build_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ok = 0
    for name in names:
        t0 = time.time()
        try:
            df = catalog.QUERIES[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            stypes = [f.dataType.simpleString() for f in df.schema.fields]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            continue
        dt = time.time() - t0
        sql = catalog.ORACLE.get(name)
        if sql is None:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {dt:.1f}s")
            ok += 1
            continue
        try:
            rel = con.sql(sql)
            dcols = rel.columns
            dtypes = [str(t) for t in rel.types]
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {name}: columns {sorted(scols)} vs {sorted(dcols)}")
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a != b:
            sa, sb = set(a), set(b)
            print(f"FAIL {name}: rows {len(a)} vs {len(b)}; spark-only {list(sa - sb)[:3]}; "
                  f"duck-only {list(sb - sa)[:3]}")
            continue
        ok += 1
        print(f"OK   {name}: {len(a)} rows {dt:.1f}s types={dict(zip(scols, stypes))} duck={dict(zip(dcols, dtypes))}")
    print(f"{ok}/{len(names)} passed")


if __name__ == "__main__":
    main()
