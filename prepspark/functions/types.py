"""Column type helpers (the pandas ``select_dtypes`` split, expressed on Spark schemas)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DATETIME = (T.TimestampType, T.TimestampNTZType, T.DateType)


def is_numeric_type(dt: T.DataType) -> bool:
    # Booleans are not numeric (pandas select_dtypes("number") excludes bool).
    return isinstance(dt, T.NumericType)


def is_datetime_type(dt: T.DataType) -> bool:
    return isinstance(dt, _DATETIME)


def is_flat_type(dt: T.DataType) -> bool:
    return not isinstance(dt, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    ex = set(exclude or ())
    return [f.name for f in df.schema.fields if is_numeric_type(f.dataType) and f.name not in ex]


def non_numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    ex = set(exclude or ())
    return [
        f.name
        for f in df.schema.fields
        if not is_numeric_type(f.dataType) and is_flat_type(f.dataType) and f.name not in ex
    ]


def flat_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_flat_type(f.dataType)]


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def q(name: str) -> Column:
    """Column reference that survives dots and spaces in names."""
    return F.col(f"`{name}`")


def clean_num(df: DataFrame, name: str) -> Column:
    """Numeric value as double with NaN mapped to NULL (pandas treats NaN as missing)."""
    c = q(name).cast("double")
    if isinstance(dtype_of(df, name), (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(q(name)), F.lit(None).cast("double")).otherwise(c)
    return c


def is_missing(df: DataFrame, name: str) -> Column:
    dt = dtype_of(df, name)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return q(name).isNull() | F.isnan(q(name))
    return q(name).isNull()


def as_text(df: DataFrame, name: str, null_token: str | None = "nan") -> Column:
    """``astype(str)`` analogue: value as string, missing as the literal ``nan``."""
    dt = dtype_of(df, name)
    c = q(name)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
    s = c.cast("string")
    if null_token is None:
        return s
    return F.coalesce(s, F.lit(null_token))


def stripped(c: Column) -> Column:
    """Text without white space (space, tab to carriage return) at its ends."""
    return F.regexp_replace(c, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
