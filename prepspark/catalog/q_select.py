"""Feature selection and KNN queries (FS*, MV6, MV7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import knn as K
from ..operators import select as S
from ..sources.tables import load
from . import query
from .sqlfacts import with_facts
from .sqlgen import SCHEMAS, cols, src, union


@query("fs_low_variance", with_facts("customer_dirty") +
       "SELECT \"column\", nunique_all <= 1 AS dropped, position FROM facts WHERE \"column\" <> 'c_mktsegment'")
def fs_low_variance(spark, sf):
    return S.low_variance_report(load(spark, sf, "customer_dirty"), "c_mktsegment")


def _corr_drop_sql(view, target, threshold=0.95):
    cs = cols(view, "num", exclude=(target,))
    parts = []
    for j, b in enumerate(cs):
        conds = []
        for a in cs[:j]:
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            r = (f"covar_samp(CASE WHEN {both} THEN {a} END, CASE WHEN {both} THEN {b} END) / "
                 f"nullif(stddev_samp(CASE WHEN {both} THEN {a} END) * stddev_samp(CASE WHEN {both} THEN {b} END), 0)")
            conds.append(f"abs(round(coalesce({r}, 0), 6)) > {threshold}")
        cond = " OR ".join(conds) if conds else "bool_and(false)"
        parts.append(f"SELECT '{b}' AS \"column\", ({cond}) AS dropped FROM src")
    return src(view) + union(parts)


@query("fs_correlation", _corr_drop_sql("customer_dirty", "c_mktsegment"))
def fs_correlation(spark, sf):
    return S.correlation_report(load(spark, sf, "customer_dirty"), "c_mktsegment")


def _mi_sql(view, target, problem, ratio=0.8, bins=10):
    xs = cols(view, "num", exclude=(target,))
    probs = "[" + ", ".join(f"{i / bins}" for i in range(bins + 1)) + "]"
    ctes = []
    for i, c in enumerate(xs):
        ctes.append(f"e{i} AS (SELECT list_filter(qs, lambda v, j: j = 1 OR v - qs[j - 1] > 1e-8) AS ed FROM "
                    f"(SELECT quantile_cont(coalesce(CAST({c} AS DOUBLE), 0.0), {probs}) AS qs FROM src))")
    if problem == "classification":
        yk = f"coalesce(CAST({target} AS VARCHAR), 'nan')"
        ycte = ""
    else:
        ctes.append(f"ey AS (SELECT list_filter(qs, lambda v, j: j = 1 OR v - qs[j - 1] > 1e-8) AS ed FROM "
                    f"(SELECT quantile_cont(coalesce(CAST({target} AS DOUBLE), 0.0), {probs}) AS qs FROM src))")
        yk = f"CAST(len(list_filter(ey.ed[2:len(ey.ed) - 1], lambda v: coalesce(CAST({target} AS DOUBLE), 0.0) >= v)) AS VARCHAR)"
        ycte = ", ey"
    parts = []
    for i, c in enumerate(xs):
        parts.append(f"SELECT '{c}' AS col, {i} AS position, len(list_filter(e{i}.ed[2:len(e{i}.ed) - 1], "
                     f"lambda v: coalesce(CAST({c} AS DOUBLE), 0.0) >= v)) AS xb, {yk} AS yk FROM src, e{i}{ycte}")
    n_keep = max(2, int(len(xs) * ratio))
    return (src(view) + ", " + ",\n".join(ctes) + f""",
lng AS ({union(parts)}),
cnt AS (SELECT col, position, xb, yk, count(*) AS n FROM lng GROUP BY ALL),
m AS (SELECT *, sum(n) OVER (PARTITION BY col) AS nn, sum(n) OVER (PARTITION BY col, xb) AS nx,
             sum(n) OVER (PARTITION BY col, yk) AS ny FROM cnt),
s AS (SELECT col, position, sum(n / nn * ln(n * nn / (nx * ny))) AS mi FROM m GROUP BY col, position)
SELECT col AS "column", round(mi, 6) AS mi, row_number() OVER (ORDER BY mi DESC, position ASC) <= {n_keep} AS kept FROM s""")


@query("mutual_info", _mi_sql("doc_quality", "quality", "classification"))
def mutual_info(spark, sf):
    return S.mutual_info_report(load(spark, sf, "doc_quality"), "quality", "classification")


@query("mutual_info_regression", _mi_sql("lineitem", "l_extendedprice", "regression"))
def mutual_info_regression(spark, sf):
    return S.mutual_info_report(load(spark, sf, "lineitem"), "l_extendedprice", "regression")


def _mi_knn_sql(view, target, columns, k=3):
    """The nearest-neighbour estimate by all pairs; psi of whole numbers by harmonic sums."""
    psi = lambda e: f"(coalesce(list_sum(list_transform(range(1, ({e})::BIGINT), lambda i: 1.0 / i)), 0) - 0.5772156649015329)"
    parts = []
    for c in columns:
        x = f"coalesce(CAST({c} AS DOUBLE), 0)"
        parts.append(f"""SELECT '{c}' AS "column", greatest(0, round({psi("any_value(n)")} + avg({psi("k")}) - avg({psi("size")}) - avg({psi("m")}), 6)) AS mi FROM (
  SELECT p.id, any_value(p.k) AS k, any_value(p.size) AS size, any_value(p.n) AS n,
         count(*) FILTER (CASE WHEN r > 0 THEN abs(o.x - p.x) < r ELSE o.x = p.x END) AS m
  FROM (SELECT a.id, any_value(a.x) AS x, any_value(a.k) AS k, any_value(a.size) AS size, any_value(a.n) AS n,
               list_sort(list(abs(b.x - a.x)))[any_value(a.k)] AS r
        FROM pts_{c} a JOIN pts_{c} b ON a.y = b.y AND a.id <> b.id GROUP BY a.id) p, pts_{c} o GROUP BY p.id)""")
    ctes = [f"""all_{c} AS (SELECT row_number() OVER () AS id, coalesce(CAST({target} AS VARCHAR), 'nan') AS y, coalesce(CAST({c} AS DOUBLE), 0) AS v FROM src),
pts_{c} AS (SELECT id, y, v / (SELECT CASE WHEN stddev_pop(v) > 0 THEN stddev_pop(v) ELSE 1 END FROM all_{c}) AS x, size, least({k}, size - 1) AS k, count(*) OVER () AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY y) AS size FROM all_{c}) WHERE size > 1)""" for c in columns]
    return src(view) + ", " + ",\n".join(ctes) + "\n" + union(parts)


@query("mutual_info_knn", _mi_knn_sql("doc_quality", "quality", ["doc_id", "n_chars", "toxic"]))
def mutual_info_knn(spark, sf):
    """FS3 by nearest neighbours, ties as they are."""
    found = S.knn_mutual_info(load(spark, sf, "doc_quality"), ["doc_id", "n_chars", "toxic"], "quality", jitter=False)
    return found.select("column", F.round("mi", 6).alias("mi"))


@query("embedded_importance")
def embedded_importance(spark, sf):
    return S.embedded_report(load(spark, sf, "doc_quality"), "quality", "classification", trees=100)


@query("feature_selection")
def feature_selection(spark, sf):
    df = load(spark, sf, "doc_quality")
    rep = S.fit_selector(df, "quality", "classification", trees=50)
    rows = []
    for step in ("low_variance_dropped", "high_correlation_dropped", "mutual_info_dropped", "embedded_dropped"):
        rows += [(step, c) for c in rep[step]]
    rows += [("selected", c) for c in rep["selected_features"]]
    return spark.createDataFrame(rows, "step string, column string")


@query("select_features_basic")
def select_features_basic(spark, sf):
    df = load(spark, sf, "customer_dirty")
    rep = S.fit_selector(df, "c_nationkey", mode="basic")
    rows = [("removed", c) for c in rep["removed"]] + [("selected", c) for c in rep["selected_features"]]
    return spark.createDataFrame(rows, "step string, column string")


# ---- MV6 / MV7 ---------------------------------------------------------------------

def _knn_sql(view, key, k, digits=4):
    nums = cols(view, "num")
    p = len(nums)
    targets = ["c_acctbal", "c_limit"]
    present = " + ".join(f"CASE WHEN r.{c} IS NOT NULL AND d.{c} IS NOT NULL THEN 1 ELSE 0 END" for c in nums)
    sq = " + ".join(f"coalesce((r.{c} - d.{c}) * (r.{c} - d.{c}), 0.0)" for c in nums)
    ctes = [f"b AS (SELECT {key} AS kk, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in nums) + " FROM src)"]
    for t in targets:
        ctes.append(f"""t_{t} AS (SELECT rk, avg(val) AS fill FROM (
  SELECT r.kk AS rk, d.kk AS dk, d.{t} AS val, row_number() OVER (PARTITION BY r.kk ORDER BY sqrt({p}.0 / ({present}) * ({sq})), d.kk) AS rn
  FROM b r, b d WHERE r.{t} IS NULL AND d.{t} IS NOT NULL) WHERE rn <= {k} GROUP BY rk)""")
    sel = []
    for c, kind in SCHEMAS[view]:
        if c in targets:
            sel.append(f"round(coalesce(CAST(src.{c} AS DOUBLE), t_{c}.fill), {digits}) AS {c}")
        else:
            sel.append(f"src.{c}")
    joins = " ".join(f"LEFT JOIN t_{t} ON t_{t}.rk = src.{key}" for t in targets)
    return src(view) + ", " + ",\n".join(ctes) + f"\nSELECT {', '.join(sel)} FROM src {joins}"


def _knn(spark, sf, k):
    df = load(spark, sf, "customer_dirty")
    out = K.knn_impute(df, key="c_custkey", k=k)
    return out.select(*[F.round(c, 4).alias(c) if c in ("c_acctbal", "c_limit") else F.col(c) for c in out.columns])


@query("knn_impute", _knn_sql("customer_dirty", "c_custkey", 5))
def knn_impute(spark, sf):
    return _knn(spark, sf, None)


@query("knn_impute_k3", _knn_sql("customer_dirty", "c_custkey", 3))
def knn_impute_k3(spark, sf):
    return _knn(spark, sf, 3)
