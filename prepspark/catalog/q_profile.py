"""Profiling and dashboard queries (PR*, ST1, VZ*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..sources.tables import load
from . import query
from .sqlgen import SCHEMAS, as_text, cols, detected_type, position, src, union

R4 = 4  # decimals compared for doubles


def _round_all(df, digits=R4):
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _semantic_sql(view, text_len):
    parts = [
        f"SELECT '{c}' AS \"column\", {position(view, c)} AS position, {detected_type(view, c, text_len)} AS detected_type FROM src"
        for c, _ in SCHEMAS[view]
    ]
    return src(view) + union(parts)


@query("semantic_types", _semantic_sql("orders_dirty", 18))
def semantic_types(spark, sf):
    return P.semantic_types(load(spark, sf, "orders_dirty"), text_len=18)


@query("semantic_types_strict", _semantic_sql("documents", 20))
def semantic_types_strict(spark, sf):
    return P.semantic_types(load(spark, sf, "documents"), text_len=20)


def _shape_sql(view, dtypes):
    n = len(SCHEMAS[view])
    parts = [
        f"SELECT '{c}' AS \"column\", {i} AS position, '{dtypes[c]}' AS dtype, count(*) AS \"rows\", CAST({n} AS BIGINT) AS \"columns\" FROM src"
        for i, (c, _) in enumerate(SCHEMAS[view])
    ]
    return src(view) + union(parts)


_EVENT_DTYPES = {"event_id": "int64", "ts": "datetime64[us]", "user_id": "int64", "event_type": "object",
                 "value": "float64", "props": "object"}


@query("profile_shape", _shape_sql("events", _EVENT_DTYPES))
def profile_shape(spark, sf):
    return P.profile_shape(load(spark, sf, "events"))


def _missing_sql(view):
    parts = [
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, "
        f"round((count(*) - count({c})) * 100.0 / greatest(count(*), 1), 2) AS missing_pct FROM src"
        for c, _ in SCHEMAS[view]
    ]
    return src(view) + union(parts)


@query("profile_missing", _missing_sql("orders_dirty"))
def profile_missing(spark, sf):
    return P.profile_missing(load(spark, sf, "orders_dirty"))


@query("issues_missing", _missing_sql("customer_dirty"))
def issues_missing(spark, sf):
    return P.profile_missing(load(spark, sf, "customer_dirty"))


def _unique_sql(view):
    parts = [f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS nunique FROM src" for c, _ in SCHEMAS[view]]
    return src(view) + union(parts)


@query("profile_unique", _unique_sql("customer_dirty"))
def profile_unique(spark, sf):
    return P.profile_unique(load(spark, sf, "customer_dirty"))


def _describe_sql(view):
    parts = []
    for c in cols(view, "num"):
        parts.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(coalesce(avg({c}), 0), 4) AS mean, "
            f"round(coalesce(stddev_samp({c}), 0), 4) AS std, round(coalesce(min({c}), 0), 4) AS min, "
            f"round(coalesce(quantile_cont({c}, 0.25), 0), 4) AS q25, round(coalesce(quantile_cont({c}, 0.5), 0), 4) AS q50, "
            f"round(coalesce(quantile_cont({c}, 0.75), 0), 4) AS q75, round(coalesce(max({c}), 0), 4) AS max FROM src")
    return src(view) + union(parts)


@query("profile_describe", _describe_sql("customer_dirty"))
def profile_describe(spark, sf):
    return P.describe(load(spark, sf, "customer_dirty"))


def _summary_sql(view):
    parts = [
        f"SELECT '{c}' AS \"column\", {detected_type(view, c)} AS detected_type, "
        f"round((count(*) - count({c})) * 100.0 / greatest(count(*), 1), 2) AS missing_pct, "
        f"count(DISTINCT {c}) AS unique_values FROM src"
        for c, _ in SCHEMAS[view]
    ]
    return src(view) + union(parts)


@query("profile_column_summary", _summary_sql("orders_dirty"))
def profile_column_summary(spark, sf):
    return P.column_summary(load(spark, sf, "orders_dirty"))


_ADJ = ("CASE WHEN count({c}) < 3 THEN NULL WHEN var_pop({c}) * count({c}) < 1e-14 THEN 0.0 ELSE skewness({c}) END")
_ADJK = ("CASE WHEN count({c}) < 4 THEN NULL WHEN var_pop({c}) * count({c}) < 1e-14 THEN 0.0 ELSE kurtosis({c}) END")


def _moments_sql(view, dtypes):
    parts = []
    for i, (c, k) in enumerate(SCHEMAS[view]):
        if k == "num":
            num = (f"round(avg({c}), 4) AS mean, round(quantile_cont({c}, 0.5), 4) AS median, "
                   f"round(var_samp({c}), 4) AS variance, round({_ADJ.format(c=c)}, 4) AS skew")
        else:
            num = "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS median, CAST(NULL AS DOUBLE) AS variance, CAST(NULL AS DOUBLE) AS skew"
        parts.append(
            f"SELECT '{c}' AS \"column\", {i} AS position, '{dtypes[c]}' AS dtype, "
            f"round((count(*) - count({c})) * 100.0 / greatest(count(*), 1), 2) AS missing_pct, "
            f"count(DISTINCT {c}) AS unique_count, {num} FROM src")
    return src(view) + union(parts)


_CD_DTYPES = {"c_custkey": "int64", "c_name": "object", "c_nationkey": "int32", "c_acctbal": "float64",
              "c_mktsegment": "object", "c_note": "object", "c_constant": "object", "c_limit": "float64"}


@query("profile_moments", _moments_sql("customer_dirty", _CD_DTYPES))
def profile_moments(spark, sf):
    return _round_all(P.profile_moments(load(spark, sf, "customer_dirty")))


def _adj_sql(view):
    parts = [
        f"SELECT '{c}' AS \"column\", round({_ADJ.format(c=c)}, 6) AS skew, round({_ADJK.format(c=c)}, 6) AS kurt FROM src"
        for c in cols(view, "num")
    ]
    return src(view) + union(parts)


@query("adj_skew_kurt", _adj_sql("events"))
def adj_skew_kurt(spark, sf):
    st = P.skew_by_column(load(spark, sf, "events"))
    from ..functions.stats import numeric_stats
    from ..functions.types import numeric_columns
    df = load(spark, sf, "events")
    s = numeric_stats(df, numeric_columns(df))
    return s.select("column", F.round("skew", 6).alias("skew"), F.round("kurt", 6).alias("kurt"))


def _skew3_sql(view):
    parts = [f"SELECT '{c}' AS \"column\", round({_ADJ.format(c=c)}, 3) AS skew FROM src" for c in cols(view, "num")]
    return src(view) + union(parts)


@query("profile_skew", _skew3_sql("doc_quality"))
def profile_skew(spark, sf):
    return P.skew_by_column(load(spark, sf, "doc_quality")).select("column", "skew")


def _hist_sql(view, bins=10):
    parts = []
    for c in cols(view, "num")[:10]:
        parts.append(f"""SELECT '{c}' AS "column", b AS bin, round(lo0 + b * w, 4) AS lo, round(lo0 + (b + 1) * w, 4) AS hi, count(*) AS cnt
FROM (SELECT CAST(least(floor(({c} - mn) / w), {bins - 1}) AS INTEGER) AS b, mn AS lo0, w
      FROM src, (SELECT min({c}) AS mn, CASE WHEN max({c}) > min({c}) THEN (max({c}) - min({c})) / {bins} ELSE 1.0 END AS w FROM src) m
      WHERE {c} IS NOT NULL) t
GROUP BY b, lo0, w""")
    return src(view) + union(parts)


@query("histogram_bins", _hist_sql("events"))
def histogram_bins(spark, sf):
    return _round_all(P.histogram(load(spark, sf, "events")))


def _box_sql(view):
    parts = []
    for c in cols(view, "num")[:10]:
        parts.append(
            f"SELECT '{c}' AS \"column\", round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q1, "
            f"round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q3, "
            f"round(max({c}), 4) AS max, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std "
            f"FROM src HAVING count({c}) >= 4")
    return src(view) + union(parts)


@query("boxplot_stats", _box_sql("customer_dirty"))
def boxplot_stats(spark, sf):
    return _round_all(P.boxplot(load(spark, sf, "customer_dirty")))


def _top_sql(view, n=15):
    parts = [
        f"SELECT '{c}' AS \"column\", {as_text(c, view)} AS value, count(*) AS cnt FROM src GROUP BY 2"
        for c, k in SCHEMAS[view] if k != "num"
    ][:10]
    return (src(view) + "SELECT \"column\", value, cnt, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY cnt DESC, value ASC) AS INTEGER) AS rank FROM ("
            + union(parts) + f")) WHERE rank <= {n}")


@query("top_values", _top_sql("customer_dirty"))
def top_values(spark, sf):
    return P.top_values(load(spark, sf, "customer_dirty"))


def _corr_sql(view):
    cs = cols(view, "num")
    parts = []
    for i, a in enumerate(cs):
        for b in cs[i:]:
            r = (f"covar_samp(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {a} END, CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {b} END) / "
                 f"nullif(stddev_samp(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {a} END) * stddev_samp(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN {b} END), 0)")
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(coalesce({r}, 0), 4) AS corr FROM src")
            if a != b:
                parts.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, round(coalesce({r}, 0), 4) AS corr FROM src")
    return src(view) + union(parts)


@query("correlation_matrix", _corr_sql("customer_dirty"))
def correlation_matrix(spark, sf):
    return P.correlation(load(spark, sf, "customer_dirty"))


def _preview_sql(view, key, n=30):
    sel = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c, _ in SCHEMAS[view])
    return src(view) + f"SELECT {sel} FROM (SELECT * FROM src ORDER BY {key} LIMIT {n})"


@query("preview_rows", _preview_sql("customer_dirty", "c_custkey"))
def preview_rows(spark, sf):
    return P.preview(load(spark, sf, "customer_dirty"), key="c_custkey")
