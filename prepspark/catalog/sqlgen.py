"""Helpers that write the DuckDB oracle SQL.

The oracle is hand-written SQL per operator; these helpers only repeat a
per-column template over a known input schema (``UNION ALL`` of one SELECT
per column), the way a person would write it out by hand.
"""

from __future__ import annotations

from ..functions.dates import DATE_FORMATS, DATE_RATE
from ..sources.tables import DIRTY_VIEWS

# Input schemas of the views used by the catalog: (column, kind) in frame order.
# kind: num (numeric), str (text), ts (timestamp).
SCHEMAS = {
    "orders_dirty": [("o_orderkey", "num"), ("o_custkey", "num"), ("o_orderstatus", "str"), ("o_totalprice", "num"),
                     ("o_orderdate_text", "str"), ("o_orderpriority", "str")],
    "customer_dirty": [("c_custkey", "num"), ("c_name", "str"), ("c_nationkey", "num"), ("c_acctbal", "num"),
                       ("c_mktsegment", "str"), ("c_note", "str"), ("c_constant", "str"), ("c_limit", "num")],
    "doc_quality": [("doc_id", "num"), ("lang", "str"), ("source", "str"), ("n_chars", "num"), ("toxic", "num"),
                    ("quality", "num")],
    "events": [("event_id", "num"), ("ts", "ts"), ("user_id", "num"), ("event_type", "str"), ("value", "num"),
               ("props", "str")],
    "documents": [("doc_id", "num"), ("text", "str"), ("lang", "str"), ("source", "str"), ("n_chars", "num")],
    "customer": [("c_custkey", "num"), ("c_name", "str"), ("c_nationkey", "num"), ("c_acctbal", "num"),
                 ("c_mktsegment", "str")],
    "part": [("p_partkey", "num"), ("p_name", "str"), ("p_brand", "str"), ("p_type", "str"), ("p_size", "num"),
             ("p_retailprice", "num")],
    "lineitem": [("l_orderkey", "num"), ("l_partkey", "num"), ("l_suppkey", "num"), ("l_linenumber", "num"),
                 ("l_quantity", "num"), ("l_extendedprice", "num"), ("l_discount", "num"), ("l_tax", "num"),
                 ("l_returnflag", "str"), ("l_linestatus", "str"), ("l_shipdate", "ts")],
    "orders": [("o_orderkey", "num"), ("o_custkey", "num"), ("o_orderstatus", "str"), ("o_totalprice", "num"),
               ("o_orderdate", "ts"), ("o_orderpriority", "str")],
    "supplier": [("s_suppkey", "num"), ("s_name", "str"), ("s_nationkey", "num"), ("s_acctbal", "num")],
}


def src(view: str) -> str:
    """``WITH src AS (...)`` prefix for a view."""
    body = DIRTY_VIEWS.get(view, f"SELECT * FROM {view}")
    return f"WITH src AS ({body})\n"


def cols(view: str, kind: str | None = None, exclude=()) -> list[str]:
    return [c for c, k in SCHEMAS[view] if (kind is None or k == kind) and c not in exclude]


def kind_of(view: str, col: str) -> str:
    return dict(SCHEMAS[view])[col]


def position(view: str, col: str) -> int:
    return [c for c, _ in SCHEMAS[view]].index(col)


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def as_text(col: str, view: str) -> str:
    return f"coalesce(CAST({col} AS VARCHAR), 'nan')"


def date_rate(col: str) -> str:
    rates = [f"avg(CASE WHEN try_strptime(CAST({col} AS VARCHAR), '{d}') IS NOT NULL THEN 1.0 ELSE 0.0 END)"
             for _, d in DATE_FORMATS]
    return f"greatest({', '.join(rates)})"


def detected_type(view: str, col: str, text_len: int = 18) -> str:
    k = kind_of(view, col)
    if k == "num":
        return "min('numeric')"
    if k == "ts":
        return "min('datetime')"
    return (f"CASE WHEN {date_rate(col)} >= {DATE_RATE} THEN 'datetime' "
            f"WHEN count(DISTINCT {col}) / greatest(count(*), 1) > 0.6 "
            f"AND avg(length({as_text(col, view)})) > {text_len} THEN 'text' ELSE 'categorical' END")


def adj_skew_sql(x: str) -> str:
    return f"skewness({x})"
