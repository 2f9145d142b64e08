"""Shared statistics jobs.

Two scans feed every decision in the library:

* :func:`numeric_stats` -- one aggregate over all numeric columns (counts,
  moments, min/max, quantiles) returned as one row per column;
* :func:`value_frequency` -- an unpivot to ``(column, value)`` followed by a
  ``groupBy().count()``; from it come distinct counts, modes, dictionaries,
  top-k lists and ordinal value sets.

Both use map-side partial aggregation, so a hot value or a hot group costs
one combined row per task, never a task holding the whole group.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import as_text, clean_num, dtype_of, is_datetime_type, is_numeric_type, q

# Quantiles every stats job computes: 1%, quartiles, median, 99%.
DEFAULT_PROBS = (0.01, 0.25, 0.5, 0.75, 0.99)
# Columns per aggregate; keeps generated code under the JVM method limit.
AGG_CHUNK = 48


# Rank error of the sketch that brackets a quantile, and the counted rows up to which one aggregation
# buffer may hold a column instead: the last merge of such buffers is one task.
SKETCH_ACCURACY = 10_000
WHOLE_COLUMN = 200_000


def _brackets(df: DataFrame, exprs: dict, probs: dict, margin: float) -> dict:
    """name -> (n, [(low, high) per probability]) from one sketch aggregate."""
    names = list(exprs)
    found = {}
    for start in range(0, len(names), AGG_CHUNK):
        chunk = names[start:start + AGG_CHUNK]
        aggs = []
        for i, c in enumerate(chunk):
            ends = [e for p in probs[c] for e in (max(0.0, p - margin), min(1.0, p + margin))]
            aggs += [F.count(exprs[c]).alias(f"n{i}"), F.min(exprs[c]).alias(f"lo{i}"), F.max(exprs[c]).alias(f"hi{i}"),
                     F.percentile_approx(exprs[c], ends, SKETCH_ACCURACY).alias(f"q{i}")]
        row = df.agg(*aggs).first()
        for i, c in enumerate(chunk):
            n, lo, hi, qs = (row[f"{k}{i}"] for k in ("n", "lo", "hi", "q"))
            found[c] = (n, [(lo if p - margin <= 0 else float(qs[2 * k]), hi if p + margin >= 1 else float(qs[2 * k + 1]))
                            for k, p in enumerate(probs[c])] if n else [])
    return found


def _span_counts(df: DataFrame, exprs: dict, spans: list) -> DataFrame:
    """``(i, v, cnt)``: how often values within the i-th span (column, low, high) occur, and with no ``v`` how many lie below it.

    Counted per batch on its sorted columns, to be summed.
    """
    names = [c for c in exprs if any(c == s[0] for s in spans)]
    mine = [[(i, lo, hi) for i, (c, lo, hi) in enumerate(spans) if c == name] for name in names]

    def run(batches):
        for batch in batches:
            ids, values, counts = [], [], []
            for column, wanted in zip(batch.columns, mine):
                v = np.sort(column.drop_null().to_numpy(zero_copy_only=False))
                for i, lo, hi in wanted:
                    a, b = np.searchsorted(v, lo, "left"), np.searchsorted(v, hi, "right")
                    seen, often = np.unique(v[a:b], return_counts=True)
                    ids.append(np.full(len(seen) + 1, i))
                    values += [[None], seen]
                    counts += [[a], often]
            values = [pa.array(v, pa.float64()) for v in values]
            cols = [pa.array(np.concatenate(ids), pa.int32()), pa.concat_arrays(values), pa.array(np.concatenate(counts), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["i", "v", "cnt"])

    source = df.select(*[exprs[c].cast("double").alias(f"x{j}") for j, c in enumerate(names)])
    return source.mapInArrow(run, "i int, v double, cnt bigint")


def exact_quantiles(df: DataFrame, exprs: dict, probs) -> dict:
    """Exact linear-interpolation quantiles: ``{name: [value per probability]}`` (None for an empty column).

    A sketch only says where to look: it gives each probability a bracket of
    values.  A second scan counts what lies below the bracket and how often
    each value in it occurs (a few ten-thousandths of the rows), and the two
    neighbours of the quantile are picked by their rank.  Where the counts show
    that a bracket missed them, it is widened and counted again, so the answer
    is that of a full sort at any size; no buffer or task holds a column.
    A table of at most :data:`WHOLE_COLUMN` counted rows is answered by one
    aggregate, whose buffers that count bounds; the definition is the same.
    What reaches the driver is two numbers per column and probability.
    """
    spark = df.sparkSession
    probs = {c: [float(p) for p in (probs[c] if isinstance(probs, dict) else probs)] for c in exprs}
    out = {c: [None] * len(probs[c]) for c in exprs}
    if df.count() <= WHOLE_COLUMN:
        names = list(exprs)
        for start in range(0, len(names), AGG_CHUNK):
            chunk = names[start:start + AGG_CHUNK]
            row = df.agg(*[F.percentile(exprs[c], probs[c]).alias(f"q{i}") for i, c in enumerate(chunk)]).first()
            for i, c in enumerate(chunk):
                out[c] = [float(v) for v in row[f"q{i}"]] if row[f"q{i}"] is not None else out[c]
        return out
    open_ = dict(exprs)
    margin = 4.0 / SKETCH_ACCURACY
    while open_:
        found = _brackets(df, open_, probs, margin)
        spans = {}                      # (column, low, high) -> probabilities in it
        for c, (n, ends) in found.items():
            for k, (lo, hi) in enumerate(ends):
                if n and out[c][k] is None:
                    spans.setdefault((c, lo, hi), []).append(k)
        keys = list(spans)
        if not keys:
            break
        freq = _span_counts(df, open_, keys).groupBy("i", "v").agg(F.sum("cnt").alias("cnt"))
        targets = []
        for i, (c, _, _) in enumerate(keys):
            for k in spans[keys[i]]:
                pos = probs[c][k] * (found[c][0] - 1)
                targets += [(i, k, 0, math.floor(pos)), (i, k, 1, math.ceil(pos))]
        wanted = spark.createDataFrame(targets, "i int, k int, side int, at long")
        upto = F.sum("cnt").over(Window.partitionBy("i").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
        ranked = freq.withColumn("upto", upto).where("v IS NOT NULL")
        hit = ranked.join(F.broadcast(wanted), "i").where("at >= upto - cnt AND at < upto").select("i", "k", "side", "v")
        got = {(r["i"], r["k"], r["side"]): float(r["v"]) for r in hit.collect()}
        again = set()
        for i, (c, _, _) in enumerate(keys):
            for k in spans[keys[i]]:
                lo, hi = got.get((i, k, 0)), got.get((i, k, 1))
                if lo is None or hi is None:
                    again.add(c)
                    continue
                pos = probs[c][k] * (found[c][0] - 1)
                out[c][k] = lo if lo == hi else (math.ceil(pos) - pos) * lo + (pos - math.floor(pos)) * hi
        open_ = {c: x for c, x in open_.items() if c in again}
        margin *= 16
    return out


def adj_skew(n: Column, skew_pop: Column, m2_sum: Column) -> Column:
    """Bias-adjusted sample skewness (pandas ``Series.skew``) from the population one.

    ``n < 3`` -> NULL; zero (or floating-noise) variance -> 0.0.
    """
    g1 = F.coalesce(F.nanvl(skew_pop, F.lit(0.0)), F.lit(0.0))
    val = g1 * F.sqrt(n * (n - 1)) / (n - 2)
    return (
        F.when(n < 3, F.lit(None).cast("double"))
        .when(m2_sum < 1e-14, F.lit(0.0))
        .otherwise(val)
    )


def adj_kurt(n: Column, kurt_pop: Column, m2_sum: Column) -> Column:
    """Bias-adjusted excess kurtosis (pandas ``Series.kurt``); ``n < 4`` -> NULL."""
    g2 = F.coalesce(F.nanvl(kurt_pop, F.lit(0.0)), F.lit(0.0))
    val = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
    return (
        F.when(n < 4, F.lit(None).cast("double"))
        .when(m2_sum < 1e-14, F.lit(0.0))
        .otherwise(val)
    )


NUMERIC_STATS_SCHEMA = [
    "column", "position", "rows", "n", "nulls", "mean", "std", "std_pop", "var", "min", "max",
    "q01", "q25", "q50", "q75", "q99", "skew", "kurt", "sum_sq_dev",
]


def _moment_struct(name: str, pos: int, x: Column) -> Column:
    n = F.count(x).cast("double")
    var_pop = F.var_pop(x)
    m2_sum = F.coalesce(var_pop * n, F.lit(0.0))
    return F.struct(
        F.lit(name).alias("column"),
        F.lit(pos).alias("position"),
        F.count(F.lit(1)).alias("rows"),
        F.count(x).alias("n"),
        F.sum(F.when(x.isNull(), 1).otherwise(0)).cast("long").alias("nulls"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.stddev_pop(x).alias("std_pop"),
        F.var_samp(x).alias("var"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        adj_skew(n, F.skewness(x), m2_sum).alias("skew"),
        adj_kurt(n, F.kurtosis(x), m2_sum).alias("kurt"),
        m2_sum.alias("sum_sq_dev"),
    )


def _quantile_names(probs=DEFAULT_PROBS) -> list[str]:
    return [f"q{int(round(p * 100)):02d}" for p in probs]


def numeric_quantiles(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, q01, q25, q50, q75, q99)`` for numeric columns: exact at any size."""
    names = _quantile_names()
    found = exact_quantiles(df, {c: clean_num(df, c) for c in columns}, DEFAULT_PROBS) if columns else {}
    return df.sparkSession.createDataFrame([(c, *found[c]) for c in columns],
                                           "column string, " + ", ".join(f"{n} double" for n in names))


def numeric_stats(df: DataFrame, columns: list[str], quantiles: bool = True) -> DataFrame:
    """One row per numeric column: n, nulls, mean, std, min, max, quantiles, adj. skew/kurt.

    The moments of :data:`AGG_CHUNK` columns come from one code-generated hash
    aggregate; the quantiles from :func:`exact_quantiles`.
    ``quantiles=False`` skips them (the q-fields are NULL).
    """
    spark = df.sparkSession
    names = _quantile_names()
    if not columns:
        return spark.createDataFrame([], (
            "column string, position int, rows long, n long, nulls long, mean double, std double, "
            "std_pop double, var double, min double, max double, q01 double, q25 double, "
            "q50 double, q75 double, q99 double, skew double, kurt double, sum_sq_dev double"))
    positions = {c: i for i, c in enumerate(df.columns)}
    out = None
    for start in range(0, len(columns), AGG_CHUNK):
        chunk = columns[start:start + AGG_CHUNK]
        mom = F.array(*[_moment_struct(c, positions.get(c, -1), clean_num(df, c)) for c in chunk]).alias("s")
        part = df.agg(mom).select(F.inline("s"))
        out = part if out is None else out.unionByName(part)
    if quantiles:
        found = exact_quantiles(df, {c: clean_num(df, c) for c in columns}, DEFAULT_PROBS)
        for k, name in enumerate(names):
            values = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(found[c][k]).cast("double"))])
            out = out.withColumn(name, F.element_at(values, F.col("column")))
    else:
        out = out.select("*", *[F.lit(None).cast("double").alias(n) for n in names])
    return out.select(*NUMERIC_STATS_SCHEMA)


def moment_fields(name: str, x: Column | None) -> list[Column]:
    """Moment fields of one column for a profile struct (typed NULLs when ``x`` is None)."""
    names = ["n", "mean", "std", "std_pop", "min", "max", "skew", "kurt"]
    if x is None:
        return [F.lit(None).cast("long").alias("n")] + [F.lit(None).cast("double").alias(n) for n in names[1:]]
    n = F.count(x).cast("double")
    m2_sum = F.coalesce(F.var_pop(x) * n, F.lit(0.0))
    return [F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.stddev_pop(x).alias("std_pop"), F.min(x).alias("min"), F.max(x).alias("max"),
            adj_skew(n, F.skewness(x), m2_sum).alias("skew"), adj_kurt(n, F.kurtosis(x), m2_sum).alias("kurt")]


def value_frequency(
    df: DataFrame,
    columns: list[str],
    by: list[str] | None = None,
    null_token: str | None = None,
) -> DataFrame:
    """``(column, value, cnt)`` for every distinct value of every listed column.

    Values are rendered as strings (``cast``); missing stays NULL unless
    ``null_token`` is given.  Partial aggregation runs map-side, so a value
    that holds a third of the rows is one row per task before the shuffle.
    """
    by = list(by or [])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), as_text(df, c, null_token).alias("value")) for c in columns
    ])
    long = df.select(*[q(b) for b in by], F.inline(pairs))
    return long.groupBy(*[q(b) for b in by], "column", "value").agg(F.count(F.lit(1)).alias("cnt"))


def distinct_counts(df: DataFrame, columns: list[str], approx: bool = False, by: list[str] | None = None) -> DataFrame:
    """``(column, nunique, nunique_all)``: distinct non-null values, and distinct counting NULL as a value.

    Exact, through :func:`value_frequency` (one shuffle for all columns instead
    of one Expand copy of the data per ``countDistinct``), unless the caller
    asks for HyperLogLog++ with ``approx=True``.
    """
    by = list(by or [])
    keys = [q(b) for b in by]
    if approx:
        arr = F.array(*[
            F.struct(
                F.lit(c).alias("column"),
                F.approx_count_distinct(as_text(df, c, None)).cast("long").alias("nunique"),
                (F.approx_count_distinct(as_text(df, c, None))
                 + F.max(F.when(as_text(df, c, None).isNull(), 1).otherwise(0))).cast("long").alias("nunique_all"),
            )
            for c in columns
        ])
        return df.groupBy(*keys).agg(arr.alias("s")).select(*keys, F.inline("s"))
    freq = value_frequency(df, columns, by=by)
    return freq.groupBy(*keys, "column").agg(
        F.count("value").cast("long").alias("nunique"),
        F.count(F.lit(1)).cast("long").alias("nunique_all"),
    )


def stats_rows(stats_df: DataFrame) -> dict:
    """Collect a per-column stats frame (bounded by the number of columns) to a dict."""
    return {r["column"]: r.asDict() for r in stats_df.collect()}


def pandas_dtype_name(dt: T.DataType) -> str:
    """Name used in reports, in the vocabulary of the reference's dtype strings."""
    if isinstance(dt, (T.LongType,)):
        return "int64"
    if isinstance(dt, (T.IntegerType,)):
        return "int32"
    if isinstance(dt, (T.ShortType,)):
        return "int16"
    if isinstance(dt, (T.ByteType,)):
        return "int8"
    if isinstance(dt, T.DoubleType) or isinstance(dt, T.DecimalType):
        return "float64"
    if isinstance(dt, T.FloatType):
        return "float32"
    if isinstance(dt, T.BooleanType):
        return "bool"
    if is_datetime_type(dt):
        return "datetime64[us]"
    if is_numeric_type(dt):
        return "float64"
    return "object"


__all__ = [
    "exact_quantiles", "adj_skew", "adj_kurt", "numeric_stats", "numeric_quantiles",
    "value_frequency", "distinct_counts", "stats_rows", "pandas_dtype_name", "dtype_of",
]
