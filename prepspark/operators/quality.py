"""Issue detection and validation (IS1-IS5, VA1, LS1).

Outlier fences come from one quantile job whose few numbers per column are
kept on the driver (the fit); the counting pass then uses them as literals.
Duplicate counting is one ``groupBy(all columns)`` with map-side combine:
a row repeated a billion times collapses to one partial count per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import numeric_stats, stats_rows
from ..functions.types import as_text, clean_num, dtype_of, flat_columns, is_missing, non_numeric_columns, numeric_columns, q, stripped
from .fuzzy import fuzzy_categories


def iqr_fences(df: DataFrame, columns: list[str]) -> dict:
    """Fit: ``{column: (q1, q3, lo, hi)}``; columns with iqr == 0 or no values get None."""
    st = stats_rows(numeric_stats(df, columns))
    out = {}
    for c in columns:
        r = st[c]
        if r["q25"] is None:
            out[c] = None
            continue
        q1, q3 = r["q25"], r["q75"]
        iqr = q3 - q1
        out[c] = None if iqr == 0 else (q1, q3, q1 - 1.5 * iqr, q3 + 1.5 * iqr)
    return out


def iqr_outlier_counts(df: DataFrame, columns: list[str] | None = None, fences: dict | None = None) -> DataFrame:
    """IS3: per numeric column, rows strictly outside ``[q1-1.5iqr, q3+1.5iqr]``; iqr 0 -> 0."""
    cols = columns if columns is not None else numeric_columns(df)
    fences = fences if fences is not None else iqr_fences(df, cols)
    structs = []
    for c in cols:
        f = fences.get(c)
        x = clean_num(df, c)
        if f is None:
            n = F.lit(0).cast("long")
        else:
            n = F.sum(F.when((x < F.lit(f[2])) | (x > F.lit(f[3])), 1).otherwise(0)).cast("long")
        structs.append(F.struct(F.lit(c).alias("column"), n.alias("outliers")))
    if not structs:
        return df.sparkSession.createDataFrame([], "column string, outliers long")
    return df.agg(F.array(*structs).alias("s")).select(F.inline("s"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """IS2: rows beyond the first of each exact duplicate group (NULL equals NULL)."""
    cols = [q(c) for c in flat_columns(df)]
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("cnt"))
    return g.agg(F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def issues_summary(df: DataFrame) -> DataFrame:
    """IS1 + IS2 in one shuffle: total missing cells, overall missing %, duplicate rows."""
    cols = flat_columns(df)
    nulls_in_row = sum((F.when(is_missing(df, c), 1).otherwise(0) for c in cols), F.lit(0))
    g = df.groupBy(*[q(c) for c in cols]).agg(F.count(F.lit(1)).alias("cnt"), F.first(nulls_in_row).alias("nn"))
    out = g.agg(
        F.coalesce(F.sum(F.col("cnt") * F.col("nn")), F.lit(0)).cast("long").alias("total_missing"),
        F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
        F.coalesce(F.sum("cnt"), F.lit(0)).cast("long").alias("rows"),
    )
    return out.select(
        "total_missing", "duplicate_rows", "rows",
        F.round(F.col("total_missing") * 100.0 / F.greatest(F.col("rows") * len(cols), F.lit(1)), 2).alias("missing_pct"),
    )


def validate(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """VA1: total missing, duplicate rows, all numerics finite -> is_valid.  One shuffle.

    ``by=`` validates every group (e.g. every partition of a large table) in the same job.
    """
    by = list(by or [])
    cols = [c for c in flat_columns(df) if c not in by]
    nums = [c for c in numeric_columns(df) if c not in by]
    nulls_in_row = sum((F.when(is_missing(df, c), 1).otherwise(0) for c in cols), F.lit(0))
    finite = F.lit(True)
    for c in nums:
        x = q(c).cast("double")
        finite = finite & x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    g = df.groupBy(*[q(b) for b in by], *[q(c) for c in cols]).agg(
        F.count(F.lit(1)).alias("cnt"), F.first(nulls_in_row).alias("nn"), F.first(finite).alias("fin"))
    aggs = [
        F.coalesce(F.sum(F.col("cnt") * F.col("nn")), F.lit(0)).cast("long").alias("missing_total"),
        F.coalesce(F.sum(F.col("cnt") - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
        F.coalesce(F.min(F.col("fin").cast("int")), F.lit(1)).alias("fin"),
    ]
    out = g.groupBy(*[q(b) for b in by]).agg(*aggs) if by else g.agg(*aggs)
    return out.select(
        *[q(b) for b in by],
        ((F.col("missing_total") == 0) & (F.col("duplicate_rows") == 0) & (F.col("fin") == 1)).alias("is_valid"),
        "missing_total", "duplicate_rows", (F.col("fin") == 1).alias("numeric_finite"),
    )


def normalize_categories(df: DataFrame, exclude=()) -> DataFrame:
    """IS5: every non-numeric column -> lower case without white space at its ends, missing becoming ``nan``."""
    ex = set(exclude or ())
    targets = set(non_numeric_columns(df)) - ex
    return df.select(*[
        F.lower(stripped(as_text(df, c, "nan"))).alias(c) if c in targets else q(c) for c in df.columns
    ])


def choose_strategy(profile_df: DataFrame, outliers_df: DataFrame, target: str | None = None) -> DataFrame:
    """LS1: per-column missing strategy plus the run-wide choices.

    ``profile_df`` is :func:`profile_moments`-shaped (column, dtype, missing_pct);
    ``outliers_df`` is :func:`iqr_outlier_counts`-shaped.  The run-wide values
    are two numbers, read once and applied as literals.
    """
    total = outliers_df.agg(F.coalesce(F.sum("outliers"), F.lit(0)).alias("t")).collect()[0]["t"]
    tdtype = None
    if target:
        rows = profile_df.where(F.col("column") == F.lit(target)).select("dtype").collect()
        tdtype = rows[0]["dtype"] if rows else None
    if tdtype is None:
        scaling = "standard"
    else:
        scaling = "standard" if ("int" in tdtype or "float" in tdtype) else "robust"
    numeric_dtype = F.col("dtype").contains("int") | F.col("dtype").contains("float")
    return profile_df.select(
        "column",
        F.when(numeric_dtype, F.when(F.col("missing_pct") < 5, "mean").otherwise("median")).otherwise("mode").alias("missing"),
        F.lit("drop").alias("duplicates"),
        F.lit("iqr_cap" if total > 0 else "none").alias("outliers"),
        F.lit("fuzzy_normalize").alias("categorical"),
        F.lit("onehot").alias("encoding"),
        F.lit(scaling).alias("scaling"),
        F.lit("mutual_info_or_variance").alias("feature_selection"),
    )


def detect_issues(df: DataFrame) -> dict:
    """The reference's issue report, as DataFrames (missing, summary, IQR outliers, inconsistencies)."""
    from .profile import profile_missing

    return {
        "missing": profile_missing(df),
        "summary": issues_summary(df),
        "outliers": iqr_outlier_counts(df),
        "inconsistencies": fuzzy_categories(df),
    }


__all__ = [
    "iqr_fences", "iqr_outlier_counts", "duplicate_count", "issues_summary", "validate",
    "normalize_categories", "choose_strategy", "fuzzy_categories", "detect_issues", "dtype_of",
]
