"""Run queries on Spark and their oracle SQL on DuckDB; compare rows.

    python tools/oracle_check.py [sf_dir] [name ...]

Comparison: row count, column names, and the multiset of rows after
rounding doubles to 6 decimals (columns sorted by name).
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from prepspark.catalog import oracles, queries  # noqa: E402
from prepspark.session import local_session  # noqa: E402
from prepspark.sources.tables import TABLES, table_path  # noqa: E402


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "as_tuple"):  # Decimal
        return round(float(v), 6)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def main():
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf, t)}')")
    qs, os_ = queries(), oracles()
    names = names or list(qs)
    ok = bad = 0
    for name in names:
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {e}")
            traceback.print_exc()
            bad += 1
            continue
        ts = time.time() - t0
        if name not in os_:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            ok += 1
            continue
        try:
            res = con.execute(os_[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {e}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {name}: columns spark={scols} duck={dcols}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a == b:
            print(f"OK   {name}: {len(a)} rows {ts:.1f}s")
            ok += 1
        else:
            print(f"FAIL {name}: rows spark={len(a)} duck={len(b)}")
            sa, sb = set(a), set(b)
            for r in list(sa - sb)[:5]:
                print("   spark only:", r)
            for r in list(sb - sa)[:5]:
                print("   duck only: ", r)
            bad += 1
    print(f"ok={ok} bad={bad}")
    spark.stop()


if __name__ == "__main__":
    main()
