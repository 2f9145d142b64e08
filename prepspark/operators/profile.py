"""Profiling (PR1-PR8) and dashboard statistics (VZ1-VZ6).

Everything here returns a DataFrame built from one or two scans of the input;
nothing is collected except where a later literal needs a bound (histogram
edges).  Per-column results are "long": one row per source column, with the
column's position in the frame so callers can keep the frame's order.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.comoments import comoments
from ..functions.dates import DATE_RATE, best_rate_expr
from ..functions.names import in_scale_agg
from ..functions.stats import distinct_counts, moment_fields, numeric_stats, pandas_dtype_name, value_frequency
from ..functions.types import as_text, clean_num, dtype_of, flat_columns, is_datetime_type, is_missing, is_numeric_type, numeric_columns, non_numeric_columns, q


def _scan_struct(df: DataFrame, name: str, pos: int, with_moments: bool = False):
    dt = dtype_of(df, name)
    numeric = is_numeric_type(dt)
    dtime = is_datetime_type(dt)
    if numeric:
        rate = F.lit(0.0)
    else:
        rate = best_rate_expr(df, name)
    extra = []
    if with_moments:
        extra = moment_fields(name, clean_num(df, name) if numeric else None)
        extra.append((F.lit(True) if numeric else in_scale_agg(df, name)).alias("in_scale"))
    return F.struct(
        F.lit(name).alias("column"),
        F.lit(pos).alias("position"),
        F.lit(pandas_dtype_name(dt)).alias("dtype"),
        F.lit("numeric" if numeric else ("datetime" if dtime else "other")).alias("kind"),
        F.sum(F.when(is_missing(df, name), 1).otherwise(0)).cast("long").alias("nulls"),
        F.avg(F.length(as_text(df, name, "nan"))).alias("avg_len"),
        rate.alias("date_rate"),
        *extra,
    )


def column_profile(df: DataFrame, text_len: int = 18, approx_distinct: bool = False, by=None,
                   with_moments: bool = False) -> DataFrame:
    """One row per column: dtype, rows, nulls, missing_pct, nunique, date parse rate, detected_type.

    ``detected_type`` is the semantic type (PR1): numeric dtype -> numeric;
    datetime dtype -> datetime; >= 80% of all rows parse as a date -> datetime;
    ``nunique/rows > 0.6`` and mean text length ``> text_len`` -> text;
    otherwise categorical.  Two jobs: one aggregate, one frequency shuffle.
    """
    by = list(by or [])
    cols = [c for c in flat_columns(df) if c not in by]
    pos = {c: i for i, c in enumerate(df.columns)}
    arr = F.array(*[_scan_struct(df, c, pos[c], with_moments) for c in cols]).alias("s")
    rows = F.count(F.lit(1)).alias("rows")
    scan = (df.groupBy(*[q(b) for b in by]).agg(rows, arr) if by else df.agg(rows, arr))
    scan = scan.select(*[q(b) for b in by], "rows", F.inline("s"))
    dc = distinct_counts(df, cols, approx=approx_distinct, by=by)
    keys = by + ["column"]
    prof = scan.join(dc, on=keys, how="left")
    ratio = F.col("nunique") / F.greatest(F.col("rows"), F.lit(1))
    detected = (
        F.when(F.col("kind") == "numeric", "numeric")
        .when(F.col("kind") == "datetime", "datetime")
        .when(F.col("date_rate") >= DATE_RATE, "datetime")
        .when((ratio > 0.6) & (F.col("avg_len") > text_len), "text")
        .otherwise("categorical")
    )
    return prof.select(
        *[q(b) for b in by],
        "column", "position", "dtype", "kind", "rows", "nulls",
        F.round(F.col("nulls") * 100.0 / F.greatest(F.col("rows"), F.lit(1)), 2).alias("missing_pct"),
        F.coalesce(F.col("nunique"), F.lit(0)).cast("long").alias("nunique"),
        F.coalesce(F.col("nunique_all"), F.lit(0)).cast("long").alias("nunique_all"),
        "avg_len", "date_rate",
        detected.alias("detected_type"),
        *([F.col(c) for c in ("n", "mean", "std", "std_pop", "min", "max", "skew", "kurt", "in_scale")]
          if with_moments else []),
    )


def semantic_types(df: DataFrame, text_len: int = 18) -> DataFrame:
    """PR1 (``text_len=18``) and PR2 (``text_len=20``): ``(column, detected_type)``."""
    return column_profile(df, text_len=text_len).select("column", "position", "detected_type")


def profile_shape(df: DataFrame) -> DataFrame:
    """PR3: rows, columns, and the dtype of each column (one aggregate, no join)."""
    meta = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(i).alias("position"), F.lit(pandas_dtype_name(f.dataType)).alias("dtype"))
        for i, f in enumerate(df.schema.fields)
    ])
    out = df.agg(F.count(F.lit(1)).cast("long").alias("rows"), meta.alias("s"))
    return out.select(F.inline("s"), "rows", F.lit(len(df.columns)).cast("long").alias("columns"))


def profile_missing(df: DataFrame) -> DataFrame:
    """PR4 / IS1: missing count and percent (2 dp) per column."""
    cols = flat_columns(df)
    arr = F.array(*[
        F.struct(F.lit(c).alias("column"), F.sum(F.when(is_missing(df, c), 1).otherwise(0)).cast("long").alias("missing"))
        for c in cols
    ])
    out = df.agg(F.count(F.lit(1)).alias("rows"), arr.alias("s")).select("rows", F.inline("s"))
    return out.select(
        "column", "missing",
        F.round(F.col("missing") * 100.0 / F.greatest(F.col("rows"), F.lit(1)), 2).alias("missing_pct"),
    )


def profile_unique(df: DataFrame, approx: bool = False) -> DataFrame:
    """PR5: distinct non-null values per column."""
    return distinct_counts(df, flat_columns(df), approx=approx).select("column", "nunique")


def describe(df: DataFrame) -> DataFrame:
    """PR6: count/mean/std/min/25%/50%/75%/max per numeric column, NaN->0, rounded 4."""
    st = numeric_stats(df, numeric_columns(df))
    r = lambda c: F.round(F.coalesce(F.col(c), F.lit(0.0)), 4)
    return st.select(
        "column", F.col("n").cast("long").alias("count"), r("mean").alias("mean"), r("std").alias("std"),
        r("min").alias("min"), r("q25").alias("q25"), r("q50").alias("q50"), r("q75").alias("q75"),
        r("max").alias("max"),
    )


def column_summary(df: DataFrame) -> DataFrame:
    """PR7: (column, detected_type, missing_pct, unique_values)."""
    return column_profile(df).select(
        "column", "detected_type", "missing_pct", F.col("nunique").alias("unique_values"))


def profile_moments(df: DataFrame) -> DataFrame:
    """PR8 legacy profile: dtype, missing_pct, unique_count and, for numerics, mean/median/variance/skew."""
    prof = column_profile(df).select("column", "position", "dtype", "missing_pct", F.col("nunique").alias("unique_count"))
    st = numeric_stats(df, numeric_columns(df)).select(
        "column", "mean", F.col("q50").alias("median"), F.col("var").alias("variance"), "skew")
    return prof.join(st, "column", "left")


def skew_by_column(df: DataFrame) -> DataFrame:
    """VZ5 / ST1: adjusted skewness (3 dp) and adjusted kurtosis per numeric column."""
    st = numeric_stats(df, numeric_columns(df))
    return st.select("column", F.round("skew", 3).alias("skew"), "kurt")


def boxplot(df: DataFrame, limit_columns: int | None = None) -> DataFrame:
    """VZ2: min, q1, median, q3, max, mean, std for the first 10 numeric columns with >= 4 values."""
    cols = numeric_columns(df)[:limit_columns]
    st = numeric_stats(df, cols)
    return st.where(F.col("n") >= 4).select(
        "column", "min", F.col("q25").alias("q1"), F.col("q50").alias("median"), F.col("q75").alias("q3"),
        "max", "mean", "std")


def histogram(df: DataFrame, columns: list[str] | None = None, bins: int = 10, limit_columns: int | None = None) -> DataFrame:
    """VZ1 (re-aimed): equal-width binned counts instead of shipping raw values.

    Edges come from one min/max job (a handful of numbers per column); the
    counts are a second job with map-side combine.  Bin ``i`` covers
    ``[min + i*w, min + (i+1)*w)``, the last bin is closed.
    """
    cols = columns if columns is not None else numeric_columns(df)[:limit_columns]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, bin int, lo double, hi double, cnt long")
    mm = df.agg(*[
        e for c in cols for e in (F.min(clean_num(df, c)).alias(f"{c}\u0001lo"), F.max(clean_num(df, c)).alias(f"{c}\u0001hi"))
    ]).collect()[0].asDict()
    pairs = []
    for c in cols:
        lo, hi = mm[f"{c}\u0001lo"], mm[f"{c}\u0001hi"]
        if lo is None:
            continue
        w = (hi - lo) / bins if hi > lo else 1.0
        x = clean_num(df, c)
        b = F.least(F.floor((x - F.lit(lo)) / F.lit(w)).cast("int"), F.lit(bins - 1))
        pairs.append(F.struct(F.lit(c).alias("column"), b.alias("bin"), F.lit(lo).alias("lo0"), F.lit(w).alias("w")))
    long = df.select(F.inline(F.array(*pairs))).where(F.col("bin").isNotNull())
    return long.groupBy("column", "bin", "lo0", "w").agg(F.count(F.lit(1)).alias("cnt")).select(
        "column", "bin", (F.col("lo0") + F.col("bin") * F.col("w")).alias("lo"),
        (F.col("lo0") + (F.col("bin") + 1) * F.col("w")).alias("hi"), "cnt")


def top_values(df: DataFrame, n: int = 15, limit_columns: int | None = None) -> DataFrame:
    """VZ3: top-15 values per non-numeric column (first 10), missing counted as ``nan``.

    Ties are broken by value (Spark has no first-seen order).
    """
    cols = non_numeric_columns(df)[:limit_columns]
    freq = value_frequency(df, cols, null_token="nan")
    w = Window.partitionBy("column").orderBy(F.col("cnt").desc(), F.col("value").asc())
    return freq.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).select(
        "column", "value", F.col("cnt").cast("long").alias("cnt"), "rank")


def correlation(df: DataFrame, columns: list[str] | None = None, digits: int = 4) -> DataFrame:
    """VZ4: Pearson correlation on pair-complete rows, NaN/inf -> 0, rounded.

    One pass of mergeable co-moments serves columns with and without missing values.  The
    diagonal is 1.0 for a column with non-zero variance and 0 otherwise (pandas gives NaN -> 0).
    """
    cols = columns if columns is not None else numeric_columns(df)
    schema = "col_a string, col_b string, corr double"
    if not cols:
        return df.sparkSession.createDataFrame([], schema)
    n, a, b, saa, sbb, sab = comoments(df, [clean_num(df, c) for c in cols]).parts
    tiny = 8 * np.finfo(float).eps  # a constant column's rounding is no spread
    with np.errstate(invalid="ignore", divide="ignore"):
        flat = (saa <= n * (tiny * a) ** 2) | (sbb <= n * (tiny * b) ** 2)
        r = np.where(flat, 0.0, sab / np.sqrt(saa) / np.sqrt(sbb))
    r = np.where(np.isfinite(r), np.clip(r, -1.0, 1.0), 0.0)
    rows = [(a, b, round(float(r[i, j]), digits)) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, schema)


def preview(df: DataFrame, key: str | None = None, n: int = 30) -> DataFrame:
    """VZ6: first 30 rows by ``key`` (row order is not defined in Spark), missing as ``""``."""
    cols = flat_columns(df)
    out = df.orderBy(q(key)) if key else df
    return out.limit(n).select(*[F.coalesce(as_text(df, c, None), F.lit("")).alias(c) for c in cols])


def dashboard(df: DataFrame, key: str | None = None) -> dict:
    """VZ6 bundle: profile, charts, preview and column list, each a (lazy) DataFrame."""
    return {
        "profile": column_profile(df),
        "describe": describe(df),
        "histograms": histogram(df),
        "boxplots": boxplot(df),
        "top_values": top_values(df),
        "correlation": correlation(df),
        "skewness": skew_by_column(df),
        "preview": preview(df, key),
        "columns": list(df.columns),
    }
