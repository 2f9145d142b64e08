"""Adjusted moments, quantiles and distinct counts against pandas on small frames."""

import math

import pandas as pd
import pytest

from prepspark.functions.stats import distinct_counts, exact_quantiles, numeric_stats, stats_rows


def _frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 3.0, 10.0],
    [5.0, 5.0, 5.0, 5.0, 5.0],
    [1.0, None, 4.0, 9.0, 16.0, 25.0, None],
    [0.1, 0.2],
    [3.0, 1.0, 2.0],
    [-2.5, 7.25, 1e3, 4.0, 4.0, 8.5],
])
def test_moments_match_pandas(spark, values):
    st = stats_rows(numeric_stats(_frame(spark, values), ["x"]))["x"]
    s = pd.Series(values, dtype="float64")
    exp_skew, exp_kurt = s.skew(), s.kurt()
    for got, exp in ((st["skew"], exp_skew), (st["kurt"], exp_kurt)):
        if exp is None or (isinstance(exp, float) and math.isnan(exp)):
            assert got is None
        else:
            assert got == pytest.approx(exp, abs=1e-9)
    assert st["q25"] == pytest.approx(s.quantile(0.25))
    assert st["q50"] == pytest.approx(s.median())
    assert st["n"] == s.count()


def test_distinct_counts_null_as_value(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, None)], "s string, i int")
    got = {r["column"]: (r["nunique"], r["nunique_all"]) for r in distinct_counts(df, ["s", "i"]).collect()}
    assert got == {"s": (1, 2), "i": (1, 2)}


def test_exact_quantiles_with_brackets(spark, monkeypatch):
    """Columns above the small-column limit go through sketch, count and widening: still numpy's answer."""
    import numpy as np
    from pyspark.sql import functions as F

    from prepspark.functions import stats

    monkeypatch.setattr(stats, "WHOLE_COLUMN", 100)
    probs = [0.0, 0.01, 0.25, 1 / 3, 0.5, 0.99, 1.0]
    df = spark.range(20_011).select((F.pmod(F.xxhash64("id"), F.lit(5000)) / 7.0).alias("x"), (F.col("id") % 3).cast("double").alias("y"))
    for accuracy in (10_000, 10):
        monkeypatch.setattr(stats, "SKETCH_ACCURACY", accuracy)
        got = exact_quantiles(df, {"x": F.col("x"), "y": F.col("y"), "none": F.lit(None).cast("double")}, probs)
        rows = df.toPandas()
        for c in ("x", "y"):
            assert got[c] == pytest.approx(np.quantile(rows[c], probs).tolist(), abs=1e-9)
        assert got["none"] == [None] * len(probs)


def test_spans_are_counted_before_the_shuffle(spark, monkeypatch):
    """Quantiles of a large table: a batch gives its counts, and nulls and ties keep the definition."""
    import numpy as np
    from pyspark.sql import functions as F

    from prepspark.functions import stats as ST

    monkeypatch.setattr(ST, "WHOLE_COLUMN", 100)
    df = spark.range(6000).selectExpr("if(id % 5 = 0, null, double(id * id % 4001)) AS a", "double(id % 3) AS b", "cast(null AS double) AS c")
    exprs = {c: F.col(c) for c in "abc"}
    counts = ST._span_counts(df.coalesce(1), exprs, [("a", 100.0, 110.0), ("b", 1.0, 1.0)]).collect()
    assert len(counts) < 100 and sum(r["cnt"] for r in counts if r["i"] == 1 and r["v"] is None) == 2000
    got = ST.exact_quantiles(df, exprs, [0.0, 0.3, 0.5, 1.0])
    rows = df.toPandas()
    for c in "ab":
        assert got[c] == pytest.approx(list(np.quantile(rows[c].dropna(), [0.0, 0.3, 0.5, 1.0])))
    assert got["c"] == [None] * 4


def test_no_task_merges_a_column_of_half_a_million(spark, monkeypatch):
    from pyspark.sql import functions as F

    from prepspark.functions import stats as ST

    monkeypatch.setattr(F, "percentile", lambda *a: pytest.fail("one buffer for the column"))
    assert ST.exact_quantiles(spark.range(500_001), {"id": F.col("id").cast("double")}, [0.25, 0.5]) == {"id": [125_000.0, 250_000.0]}
