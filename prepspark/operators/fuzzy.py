"""IS4: fuzzy category inconsistencies as a similarity join and a first-leader assignment.

A value is absorbed by the first leader, in (count desc, value) order, whose lower-case form is
similar to its own (``SequenceMatcher`` ratio of at least ``FUZZY_RATIO``); a value that no
earlier leader absorbs leads.  Both parts run on Spark:

* **Join.**  A ratio of r leaves at most ``D = (1 - r) * (la + lb)`` inserted and deleted
  characters (of the parity of lb - la).  The shorter text is cut into D + 1 segments: one of
  them, the i-th, stands in the longer text with at most i edits before it, so at an offset that
  differs by at most i.  Keys are (column, both lengths, i, segment): only texts of lengths within
  the band and with an equal piece meet.  An edit-distance bound in the JVM and then the ratio
  itself decide.  No pair that the ratio admits is left out.  Free text above ``LONG``
  characters meets all texts within its length band, as the ratio has no closer bound there.
* **Assignment.**  Pairs are edges from the earlier to the later text.  Texts without an open
  earlier neighbour lead; what they reach is absorbed; edges of both close; again, until no edge
  is open.  The number of rounds is the longest chain of dependencies, not the number of values.

Nothing but loop conditions reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.types import as_text, non_numeric_columns, stripped
from ..session import cut_lineage

FUZZY_RATIO = 0.85
#: Texts above this length have so many short segments that every text of the band shares one: they meet by length.
LONG = 64


def most_edits(short: int, long: int) -> int:
    """Most insertions and deletions that texts of these lengths can differ by; -1 if none will do."""
    d = int((1 - FUZZY_RATIO) * (short + long) + 1e-9)
    d -= (d - (long - short)) % 2
    return d if d >= long - short else -1


def partners(length: int, longer: bool) -> Iterator[tuple[int, int]]:
    """(length, edits) of the texts that a text of this length can be similar to, among those as long or longer (shorter)."""
    step, other = (1, length) if longer else (-1, length)
    while other >= 0 and (d := most_edits(*sorted((length, other)))) >= 0:
        yield other, d
        other += step


def cuts(length: int, pieces: int) -> list[tuple[int, int]]:
    """(from, to) of the pieces of a text, of lengths that differ by one at most."""
    ends = [length * k // pieces for k in range(pieces + 1)]
    return list(zip(ends, ends[1:]))


def segments(text: str) -> Iterator[tuple[int, int, int, str]]:
    """(short, long, i, piece) under which a text is found as the shorter one."""
    for long, d in partners(len(text), True):
        if long > LONG:
            yield len(text), long, -1, ""
            continue
        for i, (a, b) in enumerate(cuts(len(text), d + 1)):
            yield len(text), long, i, text[a:b]


def probes(text: str) -> Iterator[tuple[int, int, int, str]]:
    """(short, long, i, piece) under which a text looks for shorter or equally long ones."""
    for short, d in partners(len(text), False):
        if len(text) > LONG:
            yield short, len(text), -1, ""
            continue
        less, more = (d - (len(text) - short)) // 2, (d + len(text) - short) // 2
        for i, (a, b) in enumerate(cuts(short, d + 1)):
            found = {text[a + s : b + s] for s in range(max(-min(less, i), -a), min(more, i) + 1) if b + s <= len(text)}
            for piece in found:
                yield short, len(text), i, piece


def similar(text: str, leader: str) -> bool:
    """Whether ``leader`` absorbs ``text``."""
    match = SequenceMatcher(None, text, leader)
    return match.quick_ratio() >= FUZZY_RATIO and match.ratio() >= FUZZY_RATIO


def _keyed(nodes: DataFrame, keys, name: str) -> DataFrame:
    """(``key``, ``<name>``, ``<name>_text``): the keys of every node."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                ids, columns, texts, rows = [], [], [], []
                for one, column, text in zip(*[c.to_pylist() for c in part.columns]):
                    for row in keys(text):
                        rows.append(row)
                        ids.append(one)
                        columns.append(column)
                        texts.append(text)
                shorts, longs, places, pieces = zip(*rows) if rows else ([], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(columns, pa.string()), pa.array(texts, pa.string()), pa.array(shorts, pa.int32()),
                     pa.array(longs, pa.int32()), pa.array(places, pa.int32()), pa.array(pieces, pa.string())],
                    ["id", "column", "text", "short", "long", "place", "piece"],
                )

    made = nodes.select("id", "column", "text").mapInArrow(
        run, "id bigint, column string, text string, short int, long int, place int, piece string"
    )
    key = F.xxhash64("column", "short", "long", "place", "piece")
    return made.select(key.alias("key"), F.col("id").alias(name), F.col("column").alias(f"{name}_column"), F.col("text").alias(f"{name}_text"))


def similar_pairs(nodes: DataFrame) -> DataFrame:
    """(``early``, ``late``): ids of similar texts of a column, from ``nodes`` (id, column, text, rank)."""
    left, right = _keyed(nodes, segments, "a"), _keyed(nodes, probes, "b")
    size = F.length("a_text") + F.length("b_text")
    near = (size > 2 * LONG) | (F.levenshtein("a_text", "b_text") <= (1 - FUZZY_RATIO) * size + 1e-9)
    met = left.join(right, "key").where((F.col("a") != F.col("b")) & (F.col("a_column") == F.col("b_column")) & near)
    met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    ends = [nodes.select(F.col("id").alias(x), F.col("text").alias(f"{x}_text"), F.col("rank").alias(f"{x}_rank")) for x in "ab"]
    met = met.join(ends[0], "a").join(ends[1], "b")
    first = F.col("a_rank") < F.col("b_rank")
    ordered = met.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("early"),
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("late"),
        F.when(first, F.col("a_text")).otherwise(F.col("b_text")).alias("leader"),
        F.when(first, F.col("b_text")).otherwise(F.col("a_text")).alias("text"),
    )

    def run(batches):
        for batch in batches:
            keep = [similar(t, lead) for lead, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select(["early", "late"]).filter(pa.array(keep, pa.bool_()))

    return ordered.mapInArrow(run, "early bigint, late bigint")


def absorbed_by_leaders(pairs: DataFrame) -> DataFrame:
    """(``late``): the nodes that a leader absorbs; all others lead."""
    spark = pairs.sparkSession
    gone = spark.createDataFrame([], "late bigint")
    active = cut_lineage(pairs)
    while not active.isEmpty():
        waiting = active.select(F.col("late").alias("early")).distinct()
        roots = active.select("early").distinct().join(waiting, "early", "left_anti")
        taken = cut_lineage(active.join(roots, "early").select("late").distinct())
        gone = gone.unionByName(taken)
        closed = taken.select(F.col("late").alias("early")).unionByName(roots)
        active = cut_lineage(active.join(closed, "early", "left_anti").join(taken, "late", "left_anti"))
    return cut_lineage(gone)


def fuzzy_categories(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """IS4: ``(column, source, target)`` for values that a fuzzy leader absorbs.

    Values are stripped of white space at their ends; missing ones take no part; leaders are
    lower-case forms.  Spark has no first-seen order, so leaders come in (count desc, value) order.
    """
    cols = columns if columns is not None else non_numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, source string, target string")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), stripped(as_text(df, c, None)).alias("value")) for c in cols])
    values = df.select(F.inline(cells)).where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    values = cut_lineage(values.withColumn("text", F.lower("value")))
    # Values with one lower-case form are similar to the same leaders, so they share a node.
    nodes = values.groupBy("column", "text").agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("rank"))
    nodes = cut_lineage(nodes.withColumn("id", F.monotonically_increasing_id()))
    pairs = cut_lineage(similar_pairs(nodes))
    gone = absorbed_by_leaders(pairs)
    led = pairs.join(gone, "late").join(gone.select(F.col("late").alias("early")), "early", "left_anti")
    leaders = nodes.select(F.col("id").alias("early"), F.col("text").alias("target"), "rank")
    first = led.join(leaders, "early").groupBy("late").agg(F.min(F.struct("rank", "target")).alias("first"))
    found = nodes.join(first, nodes["id"] == first["late"]).select("column", "text", F.col("first.target").alias("target"))
    return values.join(found, ["column", "text"]).select("column", F.col("value").alias("source"), "target")
