"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def _print(edges: DataFrame) -> tuple:
    """Count and order-free sum of hashes: equal for equal sets of edges."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(h.cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (node, root): ``root`` is the smallest node that can be reached.

    A round turns every node's larger neighbours to the smallest neighbour, then its
    smaller ones; the number of rounds grows with the logarithm of the longest path.
    Every round is two aggregations and joins, written to the shared folder; the graph
    never leaves the executors.  Self-links and repeated links are harmless; an empty
    table gives an empty result.
    """
    current = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-start"
    )
    mark = _print(current)
    while mark[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()  # a is the larger one
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        turned = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        kept = small.select("a", F.col("m").alias("b"))
        current = settle(turned.unionByName(kept).distinct(), "cc-round")
        mark, last = _print(current), mark
        if mark == last:
            break
    nodes = current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    roots = nodes.select(F.col("root").alias("node")).distinct().withColumn("root", F.col("node"))
    return nodes.unionByName(roots)
