"""Text -> timestamp parsing with a fixed list of formats.

pandas infers one format from the first value.  On Spark we try each format
of a short fixed list and keep, per column, the one with the best parse rate.
Bare numbers never parse (no loose casts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .types import dtype_of, is_datetime_type, q

# Accepted text formats (Spark pattern, DuckDB strptime pattern), in order.
DATE_FORMATS = [
    ("yyyy-MM-dd", "%Y-%m-%d"),
    ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
    ("yyyy-MM-dd'T'HH:mm:ss", "%Y-%m-%dT%H:%M:%S"),
    ("yyyy/MM/dd", "%Y/%m/%d"),
    ("MM/dd/yyyy", "%m/%d/%Y"),
]

# Cheap shape test run before each parse: a failed parse is costly inside the
# JVM, so text that cannot match a format's shape is rejected by a regex first.
_SHAPES = {
    "yyyy-MM-dd": r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$",
    "yyyy-MM-dd HH:mm:ss": r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$",
    "yyyy-MM-dd'T'HH:mm:ss": r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$",
    "yyyy/MM/dd": r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$",
    "MM/dd/yyyy": r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$",
}

# Parse-rate threshold for "this text column holds dates".
DATE_RATE = 0.8


def parse_with(c: Column, fmt: str) -> Column:
    txt = c.cast("string")
    parsed = F.try_to_timestamp(txt, F.lit(fmt)).cast("timestamp_ntz")
    shape = _SHAPES.get(fmt)
    if shape is None:
        return parsed
    return F.when(txt.rlike(shape), parsed)


def parse_rate_exprs(df: DataFrame, name: str) -> list[Column]:
    """One ``avg(parsed is not null)`` per format, over *all* rows."""
    return [
        F.avg(F.when(parse_with(q(name), fmt).isNotNull(), 1.0).otherwise(0.0))
        for fmt, _ in DATE_FORMATS
    ]


def best_rate_expr(df: DataFrame, name: str) -> Column:
    if is_datetime_type(dtype_of(df, name)):
        return F.avg(F.when(q(name).isNotNull(), 1.0).otherwise(0.0))
    return F.greatest(*parse_rate_exprs(df, name))


def parse_any(c: Column, fmt: str | None = None) -> Column:
    """Parse with one chosen format, or with the first format that matches."""
    if fmt:
        return parse_with(c, fmt)
    return F.coalesce(*[parse_with(c, f) for f, _ in DATE_FORMATS])


def as_timestamp(df: DataFrame, name: str, fmt: str | None = None) -> Column:
    if is_datetime_type(dtype_of(df, name)):
        return q(name).cast("timestamp_ntz")
    return parse_any(q(name), fmt)


def best_formats(df: DataFrame, columns: list[str]) -> dict[str, tuple[str | None, float]]:
    """For each text column: (best format, parse rate).  One aggregate job."""
    if not columns:
        return {}
    exprs = []
    for c in columns:
        for i, e in enumerate(parse_rate_exprs(df, c)):
            exprs.append(e.alias(f"{c}\u0001{i}"))
    row = df.agg(*exprs).collect()[0].asDict()
    out = {}
    for c in columns:
        rates = [row[f"{c}\u0001{i}"] or 0.0 for i in range(len(DATE_FORMATS))]
        best = max(range(len(rates)), key=lambda i: (rates[i], -i))
        out[c] = (DATE_FORMATS[best][0], rates[best])
    return out
