"""Issue detection, validation and column-analysis queries (IS*, VA1, LS1, CA*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.names import DOMAIN_KEYWORDS
from ..operators import classify as C
from ..operators import profile as P
from ..operators import quality as Q
from ..sources.tables import load
from . import query
from .sqlfacts import OUTLIER_HINT, SCALER_HINT, id_like_sql, ordinal_token_sql, with_facts
from .sqlgen import SCHEMAS, cols, src, union


@query("issues_duplicates", src("orders_dirty") +
       "SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM src)) AS BIGINT) AS duplicate_rows FROM src")
def issues_duplicates(spark, sf):
    return Q.duplicate_count(load(spark, sf, "orders_dirty"))


def _iqr_sql(view):
    parts = []
    for c in cols(view, "num"):
        parts.append(f"""SELECT '{c}' AS "column", CAST(coalesce(sum(CASE WHEN iqr > 0 AND ({c} < q1 - 1.5 * iqr OR {c} > q3 + 1.5 * iqr) THEN 1 ELSE 0 END), 0) AS BIGINT) AS outliers
FROM src, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr FROM src) f""")
    return src(view) + union(parts)


@query("issues_iqr_outliers", _iqr_sql("events"))
def issues_iqr_outliers(spark, sf):
    return Q.iqr_outlier_counts(load(spark, sf, "events"))


@query("issues_summary", src("orders_dirty") + "SELECT CAST((" + " + ".join(
    f"(count(*) - count({c}))" for c, _ in SCHEMAS["orders_dirty"]) + ") AS BIGINT) AS total_missing, "
    "CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM src)) AS BIGINT) AS duplicate_rows, count(*) AS \"rows\", "
    "round((" + " + ".join(f"(count(*) - count({c}))" for c, _ in SCHEMAS["orders_dirty"]) +
    f") * 100.0 / greatest(count(*) * {len(SCHEMAS['orders_dirty'])}, 1), 2) AS missing_pct FROM src")
def issues_summary(spark, sf):
    return Q.issues_summary(load(spark, sf, "orders_dirty"))


@query("fuzzy_categories")
def fuzzy_categories(spark, sf):
    return Q.fuzzy_categories(load(spark, sf, "part"))


def _normalize_sql(view):
    sel = ", ".join(
        (f"lower(regexp_replace(coalesce(CAST({c} AS VARCHAR), 'nan'), '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')) AS {c}" if k != "num" else c) for c, k in SCHEMAS[view])
    return src(view) + f"SELECT {sel} FROM src"


@query("normalize_categories", _normalize_sql("orders_dirty"))
def normalize_categories(spark, sf):
    return Q.normalize_categories(load(spark, sf, "orders_dirty"))


def _validate_sql(view):
    miss = " + ".join(f"(count(*) - count({c}))" for c, _ in SCHEMAS[view])
    fin = " AND ".join(f"count({c}) = count(*) AND coalesce(bool_and(isfinite(CAST({c} AS DOUBLE))), true)" for c in cols(view, "num")) or "true"
    return src(view) + f"""SELECT (m = 0 AND d = 0 AND f) AS is_valid, m AS missing_total, d AS duplicate_rows, f AS numeric_finite
FROM (SELECT CAST({miss} AS BIGINT) AS m, CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM src)) AS BIGINT) AS d, ({fin}) AS f FROM src)"""


@query("validate_dataset", _validate_sql("orders_dirty"))
def validate_dataset(spark, sf):
    return Q.validate(load(spark, sf, "orders_dirty"))


def _strategy_sql(view, target):
    iqr = []
    for c in cols(view, "num"):
        iqr.append(f"""SELECT coalesce(sum(CASE WHEN iqr > 0 AND ({c} < q1 - 1.5 * iqr OR {c} > q3 + 1.5 * iqr) THEN 1 ELSE 0 END), 0) AS o
FROM src, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr FROM src) f""")
    tkind = dict(SCHEMAS[view]).get(target)
    scaling = "standard" if tkind in (None, "num") else "robust"
    parts = []
    for c, k in SCHEMAS[view]:
        miss = (f"CASE WHEN round((count(*) - count({c})) * 100.0 / greatest(count(*), 1), 2) < 5 THEN 'mean' ELSE 'median' END"
                if k == "num" else "min('mode')")
        parts.append(f"SELECT '{c}' AS \"column\", {miss} AS missing FROM src")
    return (src(view) + f", outl AS ({union(iqr)})\n"
            f"SELECT p.\"column\", p.missing, 'drop' AS duplicates, "
            f"(SELECT CASE WHEN sum(o) > 0 THEN 'iqr_cap' ELSE 'none' END FROM outl) AS outliers, "
            f"'fuzzy_normalize' AS categorical, 'onehot' AS encoding, '{scaling}' AS scaling, "
            f"'mutual_info_or_variance' AS feature_selection FROM ({union(parts)}) p")


@query("choose_strategy", _strategy_sql("customer_dirty", "c_mktsegment"))
def choose_strategy(spark, sf):
    df = load(spark, sf, "customer_dirty")
    return Q.choose_strategy(P.profile_moments(df), Q.iqr_outlier_counts(df), target="c_mktsegment")


def _analyze_sql(view, target):
    ratio = "(nunique / greatest(\"rows\", 1))"
    cat = "(detected_type IN ('categorical', 'text'))"
    ordinal = f"({ordinal_token_sql()} OR in_scale)"
    return with_facts(view) + f"""
, a AS (
  SELECT *, CASE WHEN "column" = '{target}' THEN 'Keep (Target)'
              WHEN {id_like_sql()} THEN 'Remove (Identifier)'
              WHEN nunique <= 1 THEN 'Remove (Constant)'
              WHEN missing_pct > 50 THEN 'Remove (>50% Missing)'
              WHEN {cat} AND {ratio} >= 0.95 THEN 'Remove (High Cardinality)'
              ELSE 'Keep' END AS action,
         CASE WHEN detected_type = 'numeric' THEN round(skew, 3) END AS skew3,
         {SCALER_HINT} AS scal, {OUTLIER_HINT} AS outm
  FROM facts)
, b AS (
  SELECT *, action IN ('Keep (Target)', 'Keep') AS keeps,
         CASE WHEN action NOT IN ('Keep (Target)', 'Keep') OR "column" = '{target}' THEN 'None'
              WHEN {cat} AND nunique = 2 THEN 'LabelEncoding'
              WHEN {cat} AND {ordinal} THEN 'OrdinalEncoding'
              WHEN {cat} AND nunique >= 50 AND {ratio} > 0.15 THEN 'BinaryHashEncoding'
              WHEN {cat} AND nunique <= 20 THEN 'OneHotEncoding'
              WHEN {cat} THEN 'BinaryHashEncoding'
              WHEN detected_type = 'datetime' THEN 'DateFeatureExtraction'
              ELSE 'None' END AS enc,
         action IN ('Keep (Target)', 'Keep') AND "column" <> '{target}' AND detected_type = 'numeric' AS numeric_kept
  FROM a)
SELECT "column", position,
       CASE WHEN "column" = '{target}' THEN 'target' ELSE detected_type END AS detected_type,
       missing_pct, nunique AS unique_values,
       CASE WHEN "column" = '{target}' THEN NULL ELSE skew3 END AS skewness,
       enc AS suggested_encoding,
       CASE WHEN numeric_kept THEN scal ELSE 'None' END AS scaling,
       CASE WHEN numeric_kept THEN outm ELSE 'None' END AS outlier_method,
       action,
       CASE WHEN "column" = '{target}' THEN 'the target is left as it is'
            WHEN action = 'Remove (Identifier)' THEN 'the name is that of a key'
            WHEN action = 'Remove (Constant)' THEN 'only one value occurs'
            WHEN action = 'Remove (>50% Missing)' THEN printf('%.1f%% of the cells are empty', missing_pct)
            WHEN action = 'Remove (High Cardinality)' THEN printf('%.2f distinct values per row: a key or free text', {ratio})
            WHEN enc = 'LabelEncoding' THEN 'two values: codes 0 and 1'
            WHEN enc = 'OrdinalEncoding' THEN 'the name or the values have an order'
            WHEN {cat} AND nunique >= 50 AND {ratio} > 0.15 THEN printf('%d categories: bits of the code need fewer columns', nunique)
            WHEN enc = 'OneHotEncoding' THEN printf('%d categories without an order: one column each', nunique)
            WHEN enc = 'BinaryHashEncoding' THEN 'many categories: bits of the code'
            WHEN enc = 'DateFeatureExtraction' THEN 'a date: year, month and day'
            WHEN numeric_kept AND abs(skew3) > 2 THEN 'skewness ' || CAST(skew3 AS VARCHAR) || ': ' || scal || ', may be binned'
            WHEN numeric_kept THEN 'a number: ' || scal
            ELSE 'kept as it is' END AS reason,
       keeps AS keep
FROM b"""


@query("analyze_columns", _analyze_sql("customer_dirty", "c_mktsegment"))
def analyze_columns(spark, sf):
    return C.analyze_columns(load(spark, sf, "customer_dirty"), "c_mktsegment")


@query("analyze_columns_orders", _analyze_sql("orders_dirty", "o_orderstatus"))
def analyze_columns_orders(spark, sf):
    return C.analyze_columns(load(spark, sf, "orders_dirty"), "o_orderstatus")


def _ordinal_sql(view):
    from .sqlfacts import in_scale_sql
    parts = []
    for c, k in SCHEMAS[view]:
        if k == "num":
            continue
        parts.append(f"SELECT '{c}' AS \"column\", {in_scale_sql(c)} AS in_scale FROM src")
    return (src(view) + f"SELECT \"column\", {ordinal_token_sql()} AS name_token, in_scale, "
            f"({ordinal_token_sql()} OR in_scale) AS is_ordinal FROM ({union(parts)})")


@query("ordinal_detect", _ordinal_sql("customer_dirty"))
def ordinal_detect(spark, sf):
    return C.ordinal_detect(load(spark, sf, "customer_dirty"))


def _encodings_sql(view, target):
    ratio = "(nunique / greatest(\"rows\", 1))"
    return with_facts(view) + f"""SELECT "column", position,
  CASE WHEN nunique = 2 THEN 'label' WHEN {ratio} >= 0.95 THEN 'remove_high_cardinality'
       WHEN {ordinal_token_sql()} OR in_scale THEN 'ordinal'
       WHEN nunique >= 50 AND {ratio} > 0.15 THEN 'binary_hash'
       WHEN nunique <= 20 THEN 'onehot' ELSE 'binary_hash' END AS encoding
FROM facts WHERE kind <> 'numeric' AND "column" <> '{target}'"""


@query("suggest_encodings", _encodings_sql("events", ""))
def suggest_encodings(spark, sf):
    return C.suggest_encodings(load(spark, sf, "events"), None)


@query("suggest_encodings_orders", _encodings_sql("orders_dirty", "o_orderkey"))
def suggest_encodings_orders(spark, sf):
    return C.suggest_encodings(load(spark, sf, "orders_dirty"), "o_orderkey")


def _domain_sql(view):
    names = " ".join(c.lower() for c, _ in SCHEMAS[view])
    case = "CASE " + " ".join(
        "WHEN " + " OR ".join(f"contains(names, '{k}')" for k in keys) + f" THEN '{d}'" for d, keys in DOMAIN_KEYWORDS
    ) + " ELSE 'general' END"
    rules = ("CASE d WHEN 'finance' THEN true ELSE false END AS skip_outlier_capping, "
             "CASE d WHEN 'finance' THEN 'median' WHEN 'healthcare' THEN 'median' WHEN 'sales' THEN 'mode' "
             "WHEN 'iot' THEN 'ffill' ELSE 'auto' END AS missing_bias")
    return (src(view) + f"SELECT d AS domain, {rules}, n AS \"rows\" FROM "
            f"(SELECT {case} AS d, n FROM (SELECT '{names}' AS names, count(*) AS n FROM src))")


@query("detect_domain", _domain_sql("orders_dirty"))
def detect_domain(spark, sf):
    df = load(spark, sf, "orders_dirty")
    prof = P.profile_shape(df)
    names = prof.agg(F.concat_ws(" ", F.collect_list(F.lower("column"))).alias("names"), F.max("rows").alias("rows"))
    det = names.select(C.domain_of_names(F.col("names")).alias("domain"), "rows")
    rules = C.domain_rules_df(spark)
    return det.join(F.broadcast(rules), "domain", "left").select("domain", "skip_outlier_capping", "missing_bias", "rows")
