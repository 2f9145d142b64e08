"""Cleaning queries: missing values, duplicates, outliers, column drops, derived features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import impute as I
from ..operators import outliers as O
from ..sources.tables import load
from . import query
from .sqlfacts import OUTLIER_HINT, id_like_sql, with_facts
from .sqlgen import SCHEMAS, cols, src, union


def _r(df, names, digits=4):
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in names else F.col(c) for c in df.columns])


# ---- MV1 --------------------------------------------------------------------------

def _mv_sql(view, target):
    parts = []
    for c, k in SCHEMAS[view]:
        m = f"((count(*) - count({c})) * 100.0 / greatest(count(*), 1))"
        if k == "num":
            skew = f"CASE WHEN count({c}) < 3 THEN NULL WHEN var_pop({c}) * count({c}) < 1e-14 THEN 0.0 ELSE skewness({c}) END"
            body = (f"WHEN {m} < 5 AND abs({skew}) < 1 THEN 'mean_impute' WHEN {m} < 5 THEN 'median_impute' "
                    f"WHEN {m} <= 30 THEN 'knn_impute' ELSE 'median_impute(heavy_missing)'")
        else:
            body = (f"WHEN {m} < 5 THEN 'mode_impute' WHEN {m} <= 30 THEN 'mode_impute(moderate_missing)' "
                    f"ELSE 'mode_impute(heavy_missing)'")
        drop = f"WHEN {m} > 40 THEN printf('suggest_drop(%.2f%%_missing)', {m}) " if c != target else ""
        parts.append(f"SELECT '{c}' AS \"column\", CASE WHEN {m} = 0 THEN NULL {drop}{body} END AS action FROM src")
    return (src(view) + "SELECT \"column\", action, starts_with(action, 'suggest_drop') AS suggested_drop FROM ("
            + union(parts) + ") WHERE action IS NOT NULL")


@query("missing_actions", _mv_sql("customer_dirty", "c_mktsegment"))
def missing_actions(spark, sf):
    return I.missing_actions(load(spark, sf, "customer_dirty"), "c_mktsegment")


@query("missing_actions_orders", _mv_sql("orders_dirty", "o_orderstatus"))
def missing_actions_orders(spark, sf):
    return I.missing_actions(load(spark, sf, "orders_dirty"), "o_orderstatus")


# ---- MV2-MV5 ----------------------------------------------------------------------

def _fill_sql(view, col, fill_expr, digits=4):
    sel = []
    for c, k in SCHEMAS[view]:
        if c == col:
            e = f"coalesce(CAST({c} AS DOUBLE), ({fill_expr}))"
            sel.append(f"round({e}, {digits}) AS {c}" if k == "num" else f"coalesce({c}, ({fill_expr})) AS {c}")
        else:
            sel.append(c)
    return src(view) + f"SELECT {', '.join(sel)} FROM src"


@query("impute_mean", _fill_sql("orders_dirty", "o_totalprice", "SELECT avg(o_totalprice) FROM src"))
def impute_mean(spark, sf):
    return _r(I.impute_column(load(spark, sf, "orders_dirty"), "o_totalprice", "mean"), {"o_totalprice"})


@query("impute_median", _fill_sql("customer_dirty", "c_limit", "SELECT quantile_cont(c_limit, 0.5) FROM src"))
def impute_median(spark, sf):
    return _r(I.impute_column(load(spark, sf, "customer_dirty"), "c_limit", "median"), {"c_limit"})


@query("impute_mode", _fill_sql("orders_dirty", "o_orderpriority",
       "SELECT o_orderpriority FROM src WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 ASC LIMIT 1"))
def impute_mode(spark, sf):
    return I.impute_column(load(spark, sf, "orders_dirty"), "o_orderpriority", "mode")


@query("impute_zero", _fill_sql("customer_dirty", "c_acctbal", "SELECT 0.0"))
def impute_zero(spark, sf):
    return _r(I.impute_column(load(spark, sf, "customer_dirty"), "c_acctbal", "zero"), {"c_acctbal"})


# ---- DD1 --------------------------------------------------------------------------

@query("drop_duplicates", src("orders_dirty") + "SELECT DISTINCT * FROM src")
def drop_duplicates(spark, sf):
    out, _ = I.drop_duplicates(load(spark, sf, "orders_dirty"))
    return out


@query("drop_duplicates_count", src("orders_dirty") +
       "SELECT count(*) AS rows_before, CAST((SELECT count(*) FROM (SELECT DISTINCT * FROM src)) AS BIGINT) AS rows_after, "
       "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM src)) AS removed FROM src")
def drop_duplicates_count(spark, sf):
    _, rep = I.drop_duplicates(load(spark, sf, "orders_dirty"))
    return rep


# ---- OU1-OU7 ----------------------------------------------------------------------

@query("outlier_methods", with_facts("documents") + f"SELECT \"column\", {OUTLIER_HINT} AS method FROM facts WHERE kind = 'numeric'")
def outlier_methods(spark, sf):
    return O.outlier_methods(load(spark, sf, "documents"))


def _bounds_sql(c, method):
    if method == "iqr":
        return (f"SELECT CASE WHEN q3 - q1 > 0 THEN q1 - 1.5 * (q3 - q1) END AS lo, CASE WHEN q3 - q1 > 0 THEN q3 + 1.5 * (q3 - q1) END AS hi "
                f"FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM src)")
    if method == "zscore":
        return (f"SELECT CASE WHEN s > 0 THEN m - 3.0 * s END AS lo, CASE WHEN s > 0 THEN m + 3.0 * s END AS hi "
                f"FROM (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM src)")
    return f"SELECT quantile_cont({c}, 0.01) AS lo, quantile_cont({c}, 0.99) AS hi FROM src"


def _cap_sql(view, col, method, digits=4):
    sel = []
    for c, k in SCHEMAS[view]:
        if c == col:
            sel.append(f"round(CASE WHEN {c} IS NULL THEN NULL WHEN b.lo IS NULL THEN CAST({c} AS DOUBLE) "
                       f"ELSE least(greatest(CAST({c} AS DOUBLE), b.lo), b.hi) END, {digits}) AS {c}")
        else:
            sel.append(c)
    return src(view) + f", b AS ({_bounds_sql(col, method)})\nSELECT {', '.join(sel)} FROM src, b"


def _cap(spark, sf, view, col, method):
    df = load(spark, sf, view)
    plan = O.fit_outliers(df, columns=[col], method=method)
    return _r(plan.transform(df), {col})


@query("cap_iqr", _cap_sql("events", "value", "iqr"))
def cap_iqr(spark, sf):
    return _cap(spark, sf, "events", "value", "iqr")


@query("cap_zscore", _cap_sql("events", "value", "zscore"))
def cap_zscore(spark, sf):
    return _cap(spark, sf, "events", "value", "zscore")


@query("cap_percentile", _cap_sql("documents", "n_chars", "clipping"))
def cap_percentile(spark, sf):
    return _cap(spark, sf, "documents", "n_chars", "clipping")


def _handle_sql(view, target=None):
    return with_facts(view) + _handle_union(view, target)


def _handle_union(view, target=None):
    parts = []
    for c in cols(view, "num", exclude=(target,) if target else ()):
        meth = f"(SELECT {OUTLIER_HINT} FROM facts WHERE \"column\" = '{c}')"
        b = (f"SELECT CASE m WHEN 'zscore' THEN z.lo WHEN 'clipping' THEN p.lo ELSE i.lo END AS lo, "
             f"CASE m WHEN 'zscore' THEN z.hi WHEN 'clipping' THEN p.hi ELSE i.hi END AS hi, m FROM "
             f"({_bounds_sql(c, 'iqr')}) i, ({_bounds_sql(c, 'zscore')}) z, ({_bounds_sql(c, 'clipping')}) p, (SELECT {meth} AS m) mm")
        parts.append(f"SELECT '{c}' AS \"column\", any_value(bb.m) AS method, "
                     f"CAST(coalesce(sum(CASE WHEN bb.lo IS NOT NULL AND ({c} < bb.lo OR {c} > bb.hi) THEN 1 ELSE 0 END), 0) AS BIGINT) AS outliers_found "
                     f"FROM src, ({b}) bb")
    return union(parts)


@query("handle_outliers", _handle_sql("events"))
def handle_outliers(spark, sf):
    df = load(spark, sf, "events")
    return O.fit_outliers(df).report(spark)


def _filter_sql(view, columns):
    ctes, prev = [], "src"
    for i, c in enumerate(columns):
        cur = f"f{i}"
        ctes.append(f"""{cur} AS (SELECT {prev}.* FROM {prev}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {prev}) s
  WHERE (s.q3 - s.q1 = 0) OR ({c} >= s.q1 - 1.5 * (s.q3 - s.q1) AND {c} <= s.q3 + 1.5 * (s.q3 - s.q1)))""")
        prev = cur
    return src(view) + ", " + ",\n".join(ctes) + f"\nSELECT * FROM {prev}"


@query("filter_iqr", _filter_sql("events", ["event_id", "user_id", "value"]))
def filter_iqr(spark, sf):
    out, _ = O.filter_iqr(load(spark, sf, "events"), ["event_id", "user_id", "value"])
    return out


# ---- DC1 ----------------------------------------------------------------------------

def _drop_sql(view, target, suggested):
    sug = ", ".join(f"'{s}'" for s in suggested) or "''"
    return with_facts(view) + f"""SELECT "column", position, reason IS NOT NULL AS dropped, reason FROM (
SELECT "column", position, CASE WHEN "column" = '{target}' THEN NULL WHEN "column" IN ({sug}) THEN 'suggested'
  WHEN {id_like_sql()} THEN 'identifier' WHEN nunique_all <= 1 THEN 'constant'
  WHEN nunique / greatest("rows", 1) >= 0.95 AND kind <> 'numeric' THEN 'high_cardinality' END AS reason FROM facts)"""


@query("drop_unneeded", _drop_sql("customer_dirty", "c_mktsegment", ["c_note"]))
def drop_unneeded(spark, sf):
    return FE.column_drop_report(load(spark, sf, "customer_dirty"), "c_mktsegment", drop=["c_note"])


# ---- FE1-FE5 ------------------------------------------------------------------------

def _date_sql(view, col, fill=True, ratio=None):
    keep = [c for c, _ in SCHEMAS[view] if c != col]
    ts = f"try_strptime({col}, '%Y-%m-%d')"
    parts = []
    for p in ("year", "month", "day"):
        e = f"{p}({ts})"
        parts.append(f"CAST({'coalesce(' + e + ', 0)' if fill else e} AS INTEGER) AS {col}_{p}")
    body = f"SELECT {', '.join(keep + parts)} FROM src"
    if ratio:
        a, b = ratio
        return src(view) + f"SELECT *, round(CAST({a} AS DOUBLE) / CASE WHEN {b} = 0 THEN 1.0 ELSE CAST({b} AS DOUBLE) END, 6) AS {a}_to_{b}_ratio FROM ({body})"
    return src(view) + body


@query("date_parts", _date_sql("orders_dirty", "o_orderdate_text"))
def date_parts(spark, sf):
    df = load(spark, sf, "orders_dirty")
    plan = FE.fit_features(df, "o_orderstatus")
    plan.ratio = None
    return plan.transform(df)


@query("ratio_feature", _date_sql("orders_dirty", "o_orderdate_text", ratio=("o_orderkey", "o_custkey")))
def ratio_feature(spark, sf):
    df = load(spark, sf, "orders_dirty")
    plan = FE.fit_features(df, "o_orderstatus")
    out = plan.transform(df)
    name = f"{plan.ratio[0]}_to_{plan.ratio[1]}_ratio"
    return _r(out, {name}, 6)


@query("date_parts_nullable", _date_sql("orders_dirty", "o_orderdate_text", fill=False))
def date_parts_nullable(spark, sf):
    df = load(spark, sf, "orders_dirty")
    return FE.date_parts(df, {"o_orderdate_text": "yyyy-MM-dd"}, fill=None)


def _suggest_sql():
    return src("lineitem") + """SELECT * FROM (VALUES (0, 'ratio', 'l_orderkey_over_l_partkey', ['l_orderkey', 'l_partkey']),
 (1, 'difference', 'l_orderkey_minus_l_partkey', ['l_orderkey', 'l_partkey']),
 (2, 'interaction', 'l_orderkey_x_l_suppkey', ['l_orderkey', 'l_suppkey']),
 (3, 'date_part', 'l_shipdate_month', ['l_shipdate'])) v(idx, type, feature, columns),
 (SELECT count(l_orderkey) AS rows_covered FROM src WHERE l_orderkey IS NOT NULL) c"""


@query("suggest_features", _suggest_sql())
def suggest_features(spark, sf):
    df = load(spark, sf, "lineitem")
    sugg = FE.suggest_features(df, "l_returnflag")
    rows = df.agg(F.count("l_orderkey").alias("rows_covered")).collect()[0]["rows_covered"]
    return FE.suggestions_df(spark, sugg).withColumn("rows_covered", F.lit(rows).cast("long"))


@query("apply_suggestion", src("lineitem") + """SELECT l_orderkey, l_linenumber,
  round(CAST(l_orderkey AS DOUBLE) / CASE WHEN l_partkey = 0 THEN 1.0 ELSE CAST(l_partkey AS DOUBLE) END, 6) AS l_orderkey_over_l_partkey,
  CAST(l_orderkey - l_partkey AS DOUBLE) AS l_orderkey_minus_l_partkey,
  CAST(l_orderkey * l_suppkey AS DOUBLE) AS l_orderkey_x_l_suppkey,
  CAST(month(l_shipdate) AS INTEGER) AS l_shipdate_month FROM src""")
def apply_suggestion(spark, sf):
    df = load(spark, sf, "lineitem")
    out = df
    for s in FE.suggest_features(df, "l_returnflag"):
        out = FE.create_feature(out, s)
    return out.select("l_orderkey", "l_linenumber", F.round("l_orderkey_over_l_partkey", 6).alias("l_orderkey_over_l_partkey"),
                      "l_orderkey_minus_l_partkey", "l_orderkey_x_l_suppkey", "l_shipdate_month")
