"""Encoding, scaling and discretisation queries (EN*, SC*, DI*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classify as C
from ..operators import discretize as D
from ..operators import encode as E
from ..operators import outliers as O
from ..operators import scale as S
from ..sources.tables import load
from . import query
from .q_clean import _handle_union
from .sqlfacts import with_facts
from .sqlgen import SCHEMAS, src


def _round(df, names, digits=6):
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in names else F.col(c) for c in df.columns])


def _code(col):
    return f"(dense_rank() OVER (ORDER BY coalesce(CAST({col} AS VARCHAR), 'nan')) - 1)"


# ---- EN1-EN6 ------------------------------------------------------------------------

@query("encode_label", src("part") + f"SELECT * REPLACE (CAST({_code('p_brand')} AS INTEGER) AS p_brand) FROM src")
def encode_label(spark, sf):
    df = load(spark, sf, "part")
    return E.encode_label(df, "p_brand")


@query("encode_ordinal", src("orders_dirty") + f"SELECT * REPLACE (CAST({_code('o_orderpriority')} AS DOUBLE) AS o_orderpriority) FROM src")
def encode_ordinal(spark, sf):
    df = load(spark, sf, "orders_dirty")
    return E.encode_ordinal(df, "o_orderpriority")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "nan"]


@query("encode_onehot", src("customer_dirty") + "SELECT c_custkey, " + ", ".join(
    f"CASE WHEN coalesce(c_mktsegment, 'nan') = '{v}' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS c_mktsegment_{v}" for v in _SEGMENTS) + " FROM src")
def encode_onehot(spark, sf):
    df = load(spark, sf, "customer_dirty").select("c_custkey", "c_mktsegment")
    plan = E.fit_encoder(df, ["c_mktsegment"], decisions={"c_mktsegment": "onehot"})
    return plan.transform(df)


@query("encode_binary_hash", src("part") + "SELECT p_partkey, " + ", ".join(
    f"CAST(({_code('p_name')} >> {i}) & 1 AS INTEGER) AS p_name_bin_{i}" for i in range(7)) + " FROM src")
def encode_binary_hash(spark, sf):
    df = load(spark, sf, "part").select("p_partkey", "p_name")
    return E.encode_binary_hash(df, "p_name")


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("encode_all", src("part") + "SELECT p_partkey, p_size, p_retailprice, " + ", ".join(
    [f"CAST(({_code('p_name')} >> {i}) & 1 AS INTEGER) AS p_name_bin_{i}" for i in range(7)]
    + [f"CAST(({_code('p_brand')} >> {i}) & 1 AS INTEGER) AS p_brand_bin_{i}" for i in range(5)]
    + [f"CASE WHEN p_type = '{v}' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS p_type_{v}" for v in _TYPES]) + " FROM src")
def encode_all(spark, sf):
    df = load(spark, sf, "part")
    dec = {r["column"]: r["encoding"] for r in C.suggest_encodings(df, None).collect()}
    plan = E.fit_encoder(df, ["p_name", "p_brand", "p_type"], decisions=dec)
    return plan.transform(df)


# ---- SC1-SC7 ------------------------------------------------------------------------

def _scale_sql(view, key, columns, kind):
    sel = [key]
    for c in columns:
        if kind == "standard":
            e = f"(CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM src)) / (SELECT CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1.0 ELSE stddev_pop({c}) END FROM src)"
        elif kind == "minmax":
            e = f"(CAST({c} AS DOUBLE) - (SELECT min({c}) FROM src)) / (SELECT CASE WHEN max({c}) - min({c}) = 0 THEN 1.0 ELSE max({c}) - min({c}) END FROM src)"
        else:
            e = (f"(CAST({c} AS DOUBLE) - (SELECT quantile_cont({c}, 0.5) FROM src)) / (SELECT CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 "
                 f"THEN 1.0 ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END FROM src)")
        sel.append(f"round({e}, 6) AS {c}")
    return src(view) + f"SELECT {', '.join(sel)} FROM src"


def _scale(spark, sf, view, key, columns, kind):
    df = load(spark, sf, view).select(key, *columns)
    plan = S.fit_scaler(df, columns=columns, method=kind)
    return _round(plan.transform(df), set(columns))


@query("scale_standard", _scale_sql("customer_dirty", "c_custkey", ["c_acctbal", "c_limit"], "standard"))
def scale_standard(spark, sf):
    return _scale(spark, sf, "customer_dirty", "c_custkey", ["c_acctbal", "c_limit"], "standard")


@query("scale_minmax", _scale_sql("lineitem", "l_orderkey, l_linenumber", ["l_quantity", "l_discount"], "minmax"))
def scale_minmax(spark, sf):
    df = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    plan = S.fit_scaler(df, columns=["l_quantity", "l_discount"], method="minmax")
    return _round(plan.transform(df), {"l_quantity", "l_discount"})


@query("scale_robust", _scale_sql("events", "event_id", ["value"], "robust"))
def scale_robust(spark, sf):
    return _scale(spark, sf, "events", "event_id", ["value"], "robust")


_L2 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("scale_l2_row", src("lineitem") + "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round({c} / CASE WHEN sqrt(" + " + ".join(f"{x} * {x}" for x in _L2) + ") = 0 THEN 1.0 ELSE sqrt("
    + " + ".join(f"{x} * {x}" for x in _L2) + f") END, 6) AS {c}" for c in _L2) + " FROM src")
def scale_l2_row(spark, sf):
    df = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_L2)
    plan = S.fit_scaler(df, columns=_L2, method="normalizer")
    return _round(plan.transform(df), set(_L2))


def _scaler_choice_sql(view):
    return (with_facts(view) + f", rep AS ({_handle_union(view)})\n"
            "SELECT f.\"column\", CASE WHEN f.n < 2 THEN 'standard' WHEN coalesce(r.outliers_found, 0) > 0 THEN 'robust' "
            "WHEN abs(f.skew) < 1.0 THEN 'standard' WHEN f.min >= 0 THEN 'minmax' ELSE 'standard' END AS scaler "
            "FROM facts f LEFT JOIN rep r ON f.\"column\" = r.\"column\" WHERE f.kind = 'numeric'")


@query("scaler_choice", _scaler_choice_sql("events"))
def scaler_choice(spark, sf):
    df = load(spark, sf, "events")
    rep = O.fit_outliers(df).report(spark)
    return S.scaler_choice(df, None, rep)


def _scale_columns_sql(view):
    return (with_facts(view) + f", rep AS ({_handle_union(view)})\n"
            """, ch AS (SELECT f.*, CASE WHEN f.n < 2 THEN 'standard' WHEN coalesce(r.outliers_found, 0) > 0 THEN 'robust'
   WHEN abs(f.skew) < 1.0 THEN 'standard' WHEN f.min >= 0 THEN 'minmax' ELSE 'standard' END AS k
   FROM facts f LEFT JOIN rep r ON f."column" = r."column" WHERE f.kind = 'numeric')
SELECT "column", CASE k WHEN 'minmax' THEN 'MinMaxScaler' WHEN 'robust' THEN 'RobustScaler' ELSE 'StandardScaler' END AS scaler,
  round(CASE k WHEN 'minmax' THEN min WHEN 'robust' THEN q50 ELSE mean END, 6) AS shift,
  round(CASE k WHEN 'minmax' THEN (CASE WHEN max - min = 0 THEN 1.0 ELSE max - min END)
              WHEN 'robust' THEN (CASE WHEN q75 - q25 = 0 THEN 1.0 ELSE q75 - q25 END)
              ELSE (CASE WHEN coalesce(std_pop, 0) = 0 THEN 1.0 ELSE std_pop END) END, 6) AS scale
FROM ch""")


@query("scale_columns", _scale_columns_sql("events"))
def scale_columns(spark, sf):
    df = load(spark, sf, "events")
    op = O.fit_outliers(df)
    plan = S.fit_scaler(df, outliers=op.counts, method="auto")
    return plan.report(spark).select("column", "scaler", F.round("shift", 6).alias("shift"), F.round("scale", 6).alias("scale"))


def _majority_sql(view, target):
    return with_facts(view) + f"""
, ch AS (SELECT "column", position, CASE WHEN n < 2 THEN 'standard' WHEN abs(skew) < 1.0 THEN 'standard'
         WHEN min >= 0 THEN 'minmax' ELSE 'standard' END AS k FROM facts WHERE kind = 'numeric' AND "column" <> '{target}')
, win AS (SELECT k FROM ch GROUP BY k ORDER BY count(*) DESC, min(position) ASC LIMIT 1)
SELECT ch."column", CASE win.k WHEN 'standard' THEN 'StandardScaler' WHEN 'minmax' THEN 'MinMaxScaler' ELSE 'RobustScaler' END AS scaler
FROM ch, win"""


@query("scale_majority", _majority_sql("documents", "doc_id"))
def scale_majority(spark, sf):
    df = load(spark, sf, "documents")
    plan = S.fit_scaler(df, target="doc_id", method="majority")
    return plan.report(spark).select("column", "scaler")


# ---- DI1-DI6 ------------------------------------------------------------------------

@query("bin_candidates", with_facts("events") + """SELECT "column", n >= 20 AND (abs(skew) > 2.0 OR max - min > 1000.0) AS eligible,
CASE WHEN n >= 20 AND (abs(skew) > 2.0 OR max - min > 1000.0) THEN
  CASE WHEN abs(skew) > 3.0 THEN 'equal_freq' WHEN max - min > 10000.0 THEN 'equal_width' ELSE 'kmeans' END END AS method
FROM facts WHERE kind = 'numeric'""")
def bin_candidates(spark, sf):
    return D.bin_candidates(load(spark, sf, "events"))


def _bin_sql(view, key, c, edges_sql, k_sql):
    return src(view) + f""", e AS ({edges_sql})
SELECT {key}, CAST(CASE WHEN {c} IS NULL THEN -1 ELSE least(
  (SELECT count(*) FROM (SELECT unnest(e.edges[2:]) AS edge) WHERE {c} >= edge), {k_sql} - 1) END AS INTEGER) AS {c}_bin
FROM src, e"""


@query("bin_equal_width", _bin_sql(
    "orders_dirty", "o_orderkey", "o_totalprice",
    "SELECT [mn + i * ((mx - mn) / 5) for i in range(5)] || [mx] AS edges, 5 AS k FROM (SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM src)",
    "e.k"))
def bin_equal_width(spark, sf):
    df = load(spark, sf, "orders_dirty").select("o_orderkey", "o_totalprice")
    plan = D.fit_bins(df, columns=["o_totalprice"], method="equal_width")
    return plan.transform(df)


@query("bin_equal_freq", _bin_sql(
    "documents", "doc_id", "n_chars",
    "SELECT quantile_cont(n_chars, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS edges, 5 AS k FROM src",
    "e.k"))
def bin_equal_freq(spark, sf):
    df = load(spark, sf, "documents").select("doc_id", "n_chars")
    plan = D.fit_bins(df, columns=["n_chars"], method="equal_freq")
    return plan.transform(df)


def _kmeans_sql(view, key, c, k):
    """Lloyd rounds as a recursive query over the counted values."""
    return src(view) + f""", r AS (SELECT min({c}) AS lo, max({c}) AS hi, 1e-4 * var_pop({c}) AS tol, median({c}) AS med FROM src),
v AS (SELECT coalesce({c}, med) AS x, count(*) AS n FROM src, r GROUP BY 1),
l AS (SELECT * FROM (WITH RECURSIVE t(i, cs, shift) AS (
  SELECT 0, [lo + (hi - lo) * (2 * j + 1) / {2 * k} for j in range({k})], NULL::DOUBLE FROM r
  UNION ALL
  SELECT i + 1, new, list_sum(list_transform(range(1, {k} + 1), lambda j: (new[j] - cs[j]) ** 2)) FROM (
    SELECT t.i, t.cs, list_transform(range(1, {k} + 1), lambda j: coalesce(
      list_sum(list_transform(list_filter(vs, lambda p: (j = 1 OR p.x > (t.cs[j - 1] + t.cs[j]) / 2) AND (j = {k} OR p.x <= (t.cs[j] + t.cs[j + 1]) / 2)), lambda p: p.x * p.n))
      / list_sum(list_transform(list_filter(vs, lambda p: (j = 1 OR p.x > (t.cs[j - 1] + t.cs[j]) / 2) AND (j = {k} OR p.x <= (t.cs[j] + t.cs[j + 1]) / 2)), lambda p: p.n)),
      t.cs[j])) AS new
    FROM t, (SELECT list({{'x': x, 'n': n}}) AS vs FROM v), r WHERE i < 300 AND coalesce(shift > tol, true))
) SELECT cs FROM t ORDER BY i DESC LIMIT 1)),
e AS (SELECT [lo] || [(cs[j] + cs[j + 1]) / 2 for j in range(1, {k})] || [hi] AS edges FROM l, r)
SELECT {key}, CAST(CASE WHEN {c} IS NULL THEN -1 ELSE least(
  (SELECT count(*) FROM (SELECT unnest(e.edges[2:]) AS edge) WHERE {c} >= edge), {k - 1}) END AS INTEGER) AS {c}_bin
FROM src, e"""


@query("bin_kmeans", _kmeans_sql("events", "event_id", "value", 5))
def bin_kmeans(spark, sf):
    df = load(spark, sf, "events").select("event_id", "value")
    plan = D.fit_bins(df, columns=["value"], method="kmeans")
    return plan.transform(df)
