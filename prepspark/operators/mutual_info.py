"""FS3/FS7: mutual information of a number and a class by nearest neighbours, on sorted ranges.

For a point with N points in its class: k' = min(k, N - 1); r is the distance to its k'-th neighbour of its
class; m counts the points of all classes nearer than r (at distance 0 if r is 0).  The estimate is
``psi(n) + mean psi(k') - mean psi(N) - mean psi(m)``, at least 0; points alone in their class take no part.

In one dimension neighbours are neighbours in the order, so nothing is compared pairwise:

* ``numbered`` gives rows their place in a group's order from range partitions and the partitions' sums;
* the k' neighbours come from a window over ``BLOCK`` places, with the k places on either side as a halo;
* m is the difference of two prefix counts, looked up by sorting the bounds in among the points.

Values are divided by their standard deviation and, with ``jitter``, moved by a normal number of 1e-10 times
their mean size drawn from a hash of the row, which parts ties.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.types import as_text, clean_num, flat_columns, q
from ..session import stored

BLOCK = 20_000


def numbered(rows: DataFrame, group: list[str], order: list, weight: str | None = None) -> DataFrame:
    """``rows`` with ``place``: rows (sum of ``weight``) of the group up to and including this one, in ``order``.

    ``order`` must tell all rows of a group apart or leave it open which comes first.  A hot group is cut
    between partitions like any other range.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.col(weight) if weight else F.lit(1)
    placed = rows.repartitionByRange(parts, *group, *order).withColumn("__part", F.spark_partition_id())
    placed = stored(placed, "numbered")
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(*group, "__part").agg(F.sum(own).alias("__s"))
    sums = sums.withColumn("__before", F.coalesce(F.sum("__s").over(before), F.lit(0))).drop("__s")
    upto = Window.partitionBy(*group, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(sums, [*group, "__part"]).withColumn("place", F.col("__before") + F.sum(own).over(upto)).drop("__part", "__before")


def digamma(n: Column) -> Column:
    """psi of a positive number, to about 1e-13."""
    y = n + 8
    late = F.log(y) - 1 / (2 * y) - 1 / (12 * y**2) + 1 / (120 * y**4) - 1 / (252 * y**6)
    return late - sum((1 / (n + i) for i in range(8)), F.lit(0.0))


def _normal(seed: Column) -> Column:
    """A standard normal number from a 64-bit hash."""
    u = (F.pmod(seed, F.lit(1 << 30)) + 1) / float(1 << 30)
    v = F.pmod(F.shiftright(seed, 30), F.lit(1 << 30)) / float(1 << 30)
    return F.sqrt(-2 * F.log(u)) * F.cos(2 * math.pi * v)


def _reach(k: int) -> Column:
    """(r, lo, hi): distance of the k-th of a point's neighbours in order, and the bounds within which points are nearer.

    A bound on which a neighbour lies is that neighbour's value, so that rounding cannot let it in.
    """
    options = []
    for j in range(k + 1):  # j neighbours from below, the others from above
        low = F.col(f"lag{j}") if j else F.col("x")
        high = F.col(f"lead{k - j}") if j < k else F.col("x")
        r = F.greatest(F.col("x") - low, high - F.col("x"))
        lo = F.when(F.col("x") - low >= high - F.col("x"), low).otherwise(F.col("x") - r)
        hi = F.when(high - F.col("x") >= F.col("x") - low, high).otherwise(F.col("x") + r)
        options.append(F.when(low.isNotNull() & high.isNotNull(), F.struct(r.alias("r"), lo.alias("lo"), hi.alias("hi"))))
    return F.array_min(F.array_compact(F.array(*options)))


def knn_mutual_info(df: DataFrame, columns: list[str], target: str, k: int = 3, jitter: bool = True, block: int = BLOCK) -> DataFrame:
    """``(column, mi)`` of each numeric column (missing is 0) with the class ``target`` (missing is a class)."""
    xs = [F.coalesce(clean_num(df, c), F.lit(0.0)) for c in columns]
    facts = df.agg(*[f(x).alias(f"{n}{i}") for i, x in enumerate(xs) for n, f in (("s", F.stddev_pop), ("a", lambda v: F.avg(F.abs(v))))]).first()
    row = F.xxhash64(*[q(c) for c in flat_columns(df)])
    cells = []
    for i, x in enumerate(xs):
        scale = facts[f"s{i}"] or 1.0
        value = x / F.lit(float(scale))
        if jitter:
            value = value + F.lit(1e-10 * max(1.0, (facts[f"a{i}"] or 0.0) / scale)) * _normal(F.xxhash64(row, F.lit(i)))
        cells.append(F.struct(F.lit(i).alias("c"), value.alias("x")))
    points = df.select(as_text(df, target, "nan").alias("y"), F.explode(F.array(*cells)).alias("p")).select("y", "p.c", "p.x")

    ranked = numbered(points.withColumn("id", F.monotonically_increasing_id()), ["c", "y"], ["x", "id"])
    sizes = ranked.groupBy("c", "y").agg(F.max("place").alias("size")).where("size > 1")
    ranked = stored(ranked.join(sizes, ["c", "y"]), "ranked")
    at, home = (F.col("place") - 1) % block, F.floor((F.col("place") - 1) / block)
    homes = F.array_compact(F.array(home, F.when(at < k, home - 1), F.when(at >= block - k, home + 1)))
    spread = ranked.withColumn("home", home).withColumn("block", F.explode(homes))
    order = Window.partitionBy("c", "y", "block").orderBy("place")
    for j in range(1, k + 1):
        spread = spread.withColumns({f"lag{j}": F.lag("x", j).over(order), f"lead{j}": F.lead("x", j).over(order)})
    own = F.least(F.lit(k), F.col("size") - 1)
    reach = F.coalesce(*[F.when(own == n, _reach(n)) for n in range(1, k + 1)])
    asked = spread.where("block = home").select("c", "id", "x", "size", own.alias("k"), reach.alias("reach"))
    asked = stored(asked.select("c", "id", "x", "size", "k", "reach.*"), "asked")

    # Bounds among the points: 0 comes before equal points, 2 after them.
    def event(value, kind, sign):
        return F.struct(value.cast("double").alias("v"), F.lit(kind).alias("kind") if isinstance(kind, int) else kind.alias("kind"), F.lit(sign).alias("sign"))

    tie = F.col("r") == 0
    events = F.array(
        event(F.col("x"), 1, 0),
        event(F.col("hi"), F.when(tie, 2).otherwise(0), 1),
        event(F.col("lo"), F.when(tie, 0).otherwise(2), -1),
    )
    lines = asked.select("c", "id", F.inline(events)).withColumn("point", (F.col("sign") == 0).cast("int"))
    counted = numbered(lines, ["c"], ["v", "kind", "id", "sign"], "point")
    near = counted.where("sign <> 0").groupBy("c", "id").agg(F.sum(F.col("sign") * F.col("place")).alias("m"))
    terms = asked.join(near, ["c", "id"]).groupBy("c").agg(
        F.count(F.lit(1)).alias("n"), F.avg(digamma(F.col("k")) - digamma(F.col("size")) - digamma(F.col("m"))).alias("t"))
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "c int, column string")
    mi = F.greatest(F.lit(0.0), F.coalesce(digamma(F.col("n")) + F.col("t"), F.lit(0.0)))
    return names.join(terms, "c", "left").select("column", mi.alias("mi"))
