import numpy as np
import pytest
from pyspark.sql import functions as F

from prepspark.operators.mutual_info import digamma, knn_mutual_info, numbered
from prepspark.operators.select import mutual_info_report


def psi(n):
    return sum(1 / i for i in range(1, int(n))) - 0.5772156649015329


def brute(x, y, k):
    sizes = {c: (y == c).sum() for c in set(y)}
    keep = np.array([sizes[c] > 1 for c in y])
    x, y = x[keep] / (x.std() or 1), y[keep]
    total = []
    for i in range(len(x)):
        n = min(k, sizes[y[i]] - 1)
        r = np.sort(np.abs(np.delete(x, i)[np.delete(y, i) == y[i]] - x[i]))[n - 1]
        m = (np.abs(x - x[i]) < r).sum() if r > 0 else (x == x[i]).sum()
        total.append(psi(n) - psi(sizes[y[i]]) - psi(m))
    return max(0.0, psi(len(x)) + np.mean(total)) if total else 0.0


@pytest.mark.parametrize("block", [7, 20_000])
def test_equals_brute_force(spark, block):
    rng = np.random.default_rng(6)
    y = rng.choice(["a", "b", "c"], 260, p=[0.7, 0.25, 0.05])
    y[0] = "alone"
    x = np.stack([rng.integers(0, 1 << 20, 260) + (y == "b") * (1 << 19), rng.integers(0, 6, 260), np.where(rng.random(260) < 0.5, 4.0, rng.random(260)), np.full(260, 3.0)])
    df = spark.createDataFrame([(*map(float, r), str(c)) for r, c in zip(x.T, y)], "p double, q double, r double, s double, y string")
    got = {r["column"]: r["mi"] for r in knn_mutual_info(df.repartition(5), list("pqrs"), "y", jitter=False, block=block).collect()}
    for c, own in zip("pqrs", x):
        assert got[c] == pytest.approx(brute(own, y, 3), abs=1e-8)


def test_jitter_parts_ties_and_ranks_features(spark):
    df = spark.range(900).select(F.col("id"), (F.col("id") % 3).cast("string").alias("y"), (F.col("id") % 3 + F.rand(1) / 4).alias("good"),
                                 F.rand(2).alias("noise"), (F.col("id") % 30).cast("double").alias("steps"))
    rows = {r["column"]: r for r in mutual_info_report(df, "y", "classification", estimator="knn").collect()}
    assert rows["good"]["mi"] == pytest.approx(np.log(3), abs=0.02) and rows["noise"]["mi"] < 0.1 and rows["steps"]["mi"] > 0.9
    with pytest.raises(ValueError):
        mutual_info_report(df, "good", "regression", estimator="knn")


def test_numbered_and_digamma(spark):
    df = spark.createDataFrame([(g, float(v), i) for i, (g, v) in enumerate([(0, 2), (0, 2), (0, 1), (1, 5), (0, 9), (1, 5)])], "g int, v double, id int")
    got = {r["id"]: r["place"] for r in numbered(df, ["g"], ["v", "id"]).collect()}
    assert got == {2: 1, 0: 2, 1: 3, 4: 4, 3: 1, 5: 2}
    for r in spark.createDataFrame([(1,), (2,), (7,), (1000,)], "n int").select("n", digamma(F.col("n")).alias("p")).collect():
        assert r["p"] == pytest.approx(psi(r["n"]), abs=1e-10)


def test_empty(spark):
    df = spark.createDataFrame([], "a double, y string")
    assert [r["mi"] for r in knn_mutual_info(df, ["a"], "y").collect()] == [0.0]


def test_bins_are_counted_before_the_shuffle(spark):
    """A batch gives a row per column, bin and class, not one per row and column."""
    import numpy as np

    from prepspark.operators import select as S

    df = spark.range(5000).selectExpr("double(id % 97) AS a", "double(id % 89) AS b", "if(id % 11 = 0, null, string(id % 3)) AS y").coalesce(1)
    edges = [[0.0, 10.0, 50.0, 96.0], [0.0, 30.0, 88.0]]
    got = S._bin_counts(df, [F.col("a"), F.col("b")], edges, F.coalesce("y", F.lit("nan"))).collect()
    assert len(got) < 100
    want = {}
    for i in range(5000):
        y = "nan" if i % 11 == 0 else str(i % 3)
        for c, v in enumerate((i % 97, i % 89)):
            key = (c, int(np.searchsorted(edges[c][1:-1], v, "right")), y)
            want[key] = want.get(key, 0) + 1
    total = {}
    for r in got:
        total[r["c"], r["xb"], r["yk"]] = total.get((r["c"], r["xb"], r["yk"]), 0) + r["n"]
    assert total == want
