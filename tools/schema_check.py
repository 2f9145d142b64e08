"""Compare column type families of each query (Spark) with its oracle (DuckDB).

    python tools/schema_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from prepspark.catalog import oracles, queries  # noqa: E402
from prepspark.session import local_session  # noqa: E402
from prepspark.sources.tables import TABLES, table_path  # noqa: E402


def fam_spark(t: str) -> str:
    t = t.lower()
    if t in ("tinyint", "smallint", "int"):
        return "int32"
    if t == "bigint":
        return "int64"
    if t in ("float", "double"):
        return "float"
    if t.startswith("decimal"):
        return "decimal"
    if t.startswith("timestamp"):
        return "ts"
    if t.startswith("array"):
        return "list"
    return {"string": "str", "boolean": "bool", "date": "date"}.get(t, t)


def fam_duck(t: str) -> str:
    t = t.upper()
    if t in ("TINYINT", "SMALLINT", "INTEGER", "UTINYINT", "USMALLINT"):
        return "int32"
    if t in ("BIGINT", "HUGEINT", "UINTEGER", "UBIGINT"):
        return "int64"
    if t in ("FLOAT", "DOUBLE"):
        return "float"
    if t.startswith("DECIMAL"):
        return "decimal"
    if t.startswith("TIMESTAMP"):
        return "ts"
    if t.endswith("[]"):
        return "list"
    return {"VARCHAR": "str", "BOOLEAN": "bool", "DATE": "date"}.get(t, t)


def main():
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.001"
    names = [a for a in args if not os.path.isdir(a)]
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf, t)}')")
    qs, os_ = queries(), oracles()
    for name in names or list(os_):
        try:
            sdf = qs[name](spark, sf)
            s = {f.name: fam_spark(f.dataType.simpleString()) for f in sdf.schema.fields}
            rel = con.sql(os_[name])
            d = {c: fam_duck(str(t)) for c, t in zip(rel.columns, rel.types)}
        except Exception as e:  # noqa: BLE001
            print(f"ERR  {name}: {e}")
            continue
        diff = {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}
        print(("OK   " if not diff else "DIFF ") + name + ("" if not diff else f" {diff}"))
    spark.stop()


if __name__ == "__main__":
    main()
