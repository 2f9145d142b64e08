"""Test tables and the deterministic "dirty" views derived from them.

The dirty views are plain SQL that runs unchanged on Spark and DuckDB, so
the same text defines a query's input on both sides of the oracle check.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

ORDERS_DIRTY = """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderkey % 20 = 1 THEN lower(o_orderstatus)
            WHEN o_orderkey % 20 IN (2, 3, 4) THEN concat(' ', o_orderstatus, ' ')
            ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 25 = 3 THEN NULL ELSE o_totalprice END AS o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS o_orderdate_text,
       CASE WHEN o_orderkey % 25 = 4 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 25 = 3 THEN NULL ELSE o_totalprice END,
       CAST(CAST(o_orderdate AS DATE) AS STRING),
       CASE WHEN o_orderkey % 25 = 4 THEN NULL ELSE o_orderpriority END
FROM orders WHERE o_orderkey % 50 = 7
"""

CUSTOMER_DIRTY = """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_custkey % 10 = 1 THEN NULL ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE concat('n', CAST(c_custkey % 7 AS STRING)) END AS c_note,
       'x' AS c_constant,
       CASE WHEN c_custkey % 25 < 9 THEN NULL ELSE c_acctbal * 2 END AS c_limit
FROM customer
"""

DOC_QUALITY = """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.toxic, l.quality
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

DIRTY_VIEWS = {
    "orders_dirty": ORDERS_DIRTY,
    "customer_dirty": CUSTOMER_DIRTY,
    "doc_quality": DOC_QUALITY,
}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table, or a dirty view built from the base tables it reads."""
    if name in DIRTY_VIEWS:
        register_all(spark, sf_dir)
        return spark.sql(DIRTY_VIEWS[name])
    return spark.read.parquet(table_path(sf_dir, name))


_REGISTERED: dict = {}


def register_all(spark: SparkSession, sf_dir: str) -> None:
    """Register the base tables as temp views once per (session, folder)."""
    if _REGISTERED.get(id(spark)) == sf_dir and all(spark.catalog.tableExists(t) for t in ("orders", "documents")):
        return
    _REGISTERED[id(spark)] = sf_dir
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            spark.read.parquet(p).createOrReplaceTempView(t)


def view_sql(name: str) -> str:
    """SQL text of an input, for embedding in an oracle query as a CTE."""
    if name in DIRTY_VIEWS:
        return DIRTY_VIEWS[name]
    return f"SELECT * FROM {name}"
