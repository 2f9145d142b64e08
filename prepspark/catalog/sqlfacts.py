"""Per-column facts in DuckDB SQL, mirroring ``classify.column_facts``."""

from __future__ import annotations

from ..functions.names import ORDINAL_SCALES, ORDINAL_TOKENS
from .sqlgen import SCHEMAS, detected_type, src, union

ADJ_SKEW = "CASE WHEN count({c}) < 3 THEN NULL WHEN var_pop({c}) * count({c}) < 1e-14 THEN 0.0 ELSE skewness({c}) END"
ADJ_KURT = "CASE WHEN count({c}) < 4 THEN NULL WHEN var_pop({c}) * count({c}) < 1e-14 THEN 0.0 ELSE kurtosis({c}) END"


def in_scale_sql(c: str) -> str:
    parts = []
    for s in ORDINAL_SCALES:
        lst = ", ".join(f"'{v}'" for v in s)
        parts.append(f"coalesce(bool_and(lower(regexp_replace(CAST({c} AS VARCHAR), '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')) IN ({lst})) FILTER (WHERE {c} IS NOT NULL), true)")
    return "(" + " OR ".join(parts) + ")"


def facts_sql(view: str) -> str:
    """CTE body: one row per column of ``view`` with the facts the rules read."""
    parts = []
    for i, (c, k) in enumerate(SCHEMAS[view]):
        kind = {"num": "numeric", "ts": "datetime"}.get(k, "other")
        common = (f"SELECT '{c}' AS \"column\", {i} AS position, '{kind}' AS kind, {detected_type(view, c)} AS detected_type, "
                  f"count(*) AS \"rows\", round((count(*) - count({c})) * 100.0 / greatest(count(*), 1), 2) AS missing_pct, "
                  f"count(DISTINCT {c}) AS nunique, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS nunique_all")
        if k == "num":
            num = (f", count({c}) AS n, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, avg({c}) AS mean, stddev_samp({c}) AS std, "
                   f"stddev_pop({c}) AS std_pop, quantile_cont({c}, 0.01) AS q01, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, "
                   f"quantile_cont({c}, 0.75) AS q75, quantile_cont({c}, 0.99) AS q99, "
                   f"{ADJ_SKEW.format(c=c)} AS skew, {ADJ_KURT.format(c=c)} AS kurt, true AS in_scale")
        else:
            num = (", NULL::BIGINT AS n, NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, "
                   "NULL::DOUBLE AS std_pop, NULL::DOUBLE AS q01, NULL::DOUBLE AS q25, NULL::DOUBLE AS q50, NULL::DOUBLE AS q75, "
                   f"NULL::DOUBLE AS q99, NULL::DOUBLE AS skew, NULL::DOUBLE AS kurt, {in_scale_sql(c)} AS in_scale")
        parts.append(common + num + " FROM src")
    body = union(parts)
    return (f"SELECT *, coalesce((q75 - q25) > 0 AND (min < q25 - 1.5 * (q75 - q25) OR max > q75 + 1.5 * (q75 - q25)), false) "
            f"AS has_outliers FROM ({body})")


def with_facts(view: str) -> str:
    return src(view) + f", facts AS ({facts_sql(view)})\n"


def ordinal_token_sql(col: str = '"column"') -> str:
    return "(" + " OR ".join(f"contains(lower({col}), '{t}')" for t in ORDINAL_TOKENS) + ")"


def id_like_sql(col: str = '"column"') -> str:
    return f"(lower({col}) = 'id' OR suffix(lower({col}), '_id') OR suffix(lower({col}), 'id'))"


SCALER_HINT = ("CASE WHEN n < 2 THEN 'StandardScaler' WHEN has_outliers THEN 'RobustScaler' "
               "WHEN abs(skew) < 1.0 THEN 'StandardScaler' WHEN min >= 0 THEN 'MinMaxScaler' ELSE 'RobustScaler' END")

OUTLIER_HINT = ("CASE WHEN \"rows\" < 200 THEN 'iqr' WHEN n < 4 THEN 'iqr' "
                "WHEN abs(min) > 0 AND (max - min) > 1000 AND max / greatest(abs(min), 1e-9) > 100 THEN 'clipping' "
                "WHEN abs(skew) < 1.0 AND abs(kurt) < 3.0 THEN 'zscore' ELSE 'iqr' END")
