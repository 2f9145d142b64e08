"""Interaction audit of corpus filters: what each filter removes at each place of every order.

1. One scan gives each document the set of filters that it fails, as a number of five bits.
   Exact copies are found by the digest of the whole text: the keeper of a text is its smallest
   id, and a document fails the copy filter if it is not its text's keeper.  Keepers are joined
   by (id, digest), so that a text with millions of copies fills no task.
2. Counts per part and failure set (all documents, good ones, toxic ones) are at most
   3 * 2**5 numbers a part.  Reshaped to 2x2x2x2x2 (axis = filter, 0 = passes, 1 = fails) they
   answer every question as a contraction: along each axis a selector takes pass (1, 0), fail
   (0, 1) or all (1, 1).
3. One ``einsum`` over all selectors gives all 120 orders and 5 steps of a block of parts.

Results for odd input: null text counts as empty; a null part prints as the empty string; a null
id has no smaller id, fails no copy test and has no label; rows that repeat an id are separate documents; a
document with several labels is good (toxic) if one of them says so; labels without a document
are ignored; an empty table has no parts and no rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, let, query, settle, slices, table

MIN_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 3
SYMBOLS = "[#$%&*|]"
LETTERS = "ABCDE"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def word_counts(text: Column) -> Column:
    """Struct of a text's number of words ``n`` and of distinct words ``d``."""
    words = F.array_remove(F.split(text, BLANK), "")
    return let(words, lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))


def text_failures(text: Column, words: Column) -> list[Column]:
    """Failure conditions A to D of a text without nulls and its ``word_counts``."""
    return [
        words["n"] < MIN_WORDS,
        100 * words["d"] < LEAST_DISTINCT * words["n"],
        100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > MOST_CAPITALS * F.length(text),
        text.rlike(SYMBOLS),
    ]


def failure_sets(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """One row per document: ``part``, ``fails`` (bit i: fails the i-th filter), ``good``, ``toxic``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))

    failing = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_failures(F.col("text"), F.col("words")))), F.lit(0))
    rows = source.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), word_counts(F.col("text")).alias("words"), "text")
    rows = settle(rows.select("id", "part", "digest", failing.alias("fails")), "audit-rows")
    keepers = rows.groupBy("digest").agg(F.min("id").alias("id")).where("id IS NOT NULL").withColumn("keeper", F.lit(True))
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    found = rows.join(keepers.hint("merge"), ["id", "digest"], "left").join(marks.hint("merge"), "id", "left")
    copy = F.col("id").isNotNull() & F.col("keeper").isNull()
    return found.select(
        "part",
        (F.col("fails") + F.when(copy, 1 << 4).otherwise(0)).alias("fails"),
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


def _selectors(filters: int):
    """Orders, and the selectors (step, filter, pass/fail) of removed, kept and unique failures of all their steps."""
    orders = list(permutations(range(filters)))
    removed = np.ones((len(orders), filters, filters, 2), np.int64)
    kept, unique = removed.copy(), np.zeros_like(removed)
    unique[..., 0] = 1
    for o, order in enumerate(orders):
        for k, f in enumerate(order):
            removed[o, k, order[:k]] = kept[o, k, order[: k + 1]] = (1, 0)
            removed[o, k, f] = unique[o, k, f] = (0, 1)
    shape = (len(orders) * filters, filters, 2)
    return orders, removed.reshape(shape), kept.reshape(shape), unique.reshape(shape)


def _contract(tensors: np.ndarray, selectors: np.ndarray) -> np.ndarray:
    """tensors (part, kind, 2, 2, ...) and selectors (step, filter, 2) -> (part, kind, step)."""
    filters = selectors.shape[1]
    axes = "abcdefghij"[:filters]
    sides = [selectors[:, f] for f in range(filters)]
    return np.einsum(f"pz{axes},{','.join('s' + x for x in axes)}->pzs", tensors, *sides, optimize=True)


def interactions(tensors: np.ndarray) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """Counts of ``COUNTS`` (part, step of all orders, 7) from tensors (part, 3, 2, ...): all, good, toxic."""
    filters = tensors.ndim - 2
    orders, removed, kept, unique = _selectors(filters)
    gone = _contract(tensors, removed)
    acts = np.array(orders).ravel()
    failing = np.ones((filters, filters, 2), np.int64)
    failing[range(filters), range(filters)] = (0, 1)
    fails = _contract(tensors[:, :1], failing)[:, 0][:, acts]
    shapley = np.stack([gone[:, 0, acts == f].sum(axis=1) for f in range(filters)], axis=1)[:, acts]
    found = [_contract(tensors[:, :1], kept)[:, 0], gone[:, 0], fails - gone[:, 0], _contract(tensors[:, :1], unique)[:, 0]]
    return orders, np.stack([*found, gone[:, 1], gone[:, 2], shapley], axis=2)


def interaction_audit(sets: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per ``part``, ``filter_order`` and ``step`` with ``COUNTS``, from ``failure_sets``."""
    cells = sets.groupBy("part", "fails").agg(
        F.count("*").alias("n"), F.sum(F.col("good").cast("bigint")).alias("good"), F.sum(F.col("toxic").cast("bigint")).alias("toxic")
    )
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))  # 2**5 at most
    filters = len(letters)

    def run(batches):
        for batch in slices(batches, 64):
            if not batch.num_rows:
                continue
            flat = np.zeros((batch.num_rows, 3, 1 << filters), np.int64)
            for p, own in enumerate(batch.column(1).to_pylist()):
                for c in own:
                    flat[p, :, c["fails"]] = c["n"], c["good"], c["toxic"]
            tensors = flat.reshape(batch.num_rows, 3, *[2] * filters)  # the last axis is the lowest bit
            tensors = tensors.transpose(0, 1, *range(filters + 1, 1, -1))
            orders, found = interactions(np.ascontiguousarray(tensors))
            names = ["".join(letters[f] for f in o) for o in orders for _ in o]
            columns = {
                "part": [p for p in batch.column(0).to_pylist() for _ in names],
                "filter_order": names * batch.num_rows,
                "step": pa.array(np.tile(np.arange(1, filters + 1), len(orders) * batch.num_rows), pa.int32()),
            }
            columns |= {c: pa.array(found[:, :, i].ravel()) for i, c in enumerate(COUNTS)}
            yield pa.RecordBatch.from_pydict(columns)

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return parts.mapInArrow(run, schema)


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), least AS (SELECT text, min(doc_id) AS first FROM words GROUP BY text),
good AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text),
                regexp_matches(text, '[#$%&*|]'), coalesce(words.doc_id > first, false)] AS f,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM words LEFT JOIN least USING (text) LEFT JOIN good ON good.doc_id = words.doc_id
), cells AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS t FROM fails GROUP BY ALL
), orders(o) AS (
  SELECT '' UNION ALL SELECT o || x FROM orders, unnest(['A', 'B', 'C', 'D', 'E']) AS u(x) WHERE NOT contains(o, x)
), steps AS (
  SELECT o AS filter_order, step, ascii(o[step]) - 64 AS f,
         list_transform(range(1, step), lambda i: ascii(o[i]) - 64) AS before
  FROM orders, range(1, 6) AS r(step) WHERE len(o) = 5
), joined AS (
  SELECT part, filter_order, step::INT AS step, steps.f AS own, n, g, t, cells.f[steps.f] AS failing,
         len(list_filter(before, lambda i: cells.f[i])) > 0 AS earlier,
         len(list_filter(cells.f, lambda x: x)) AS many
  FROM cells, steps
), sums AS (
  SELECT part, filter_order, step, any_value(own) AS own,
         coalesce(sum(n) FILTER (NOT failing AND NOT earlier), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (failing AND NOT earlier), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (failing AND earlier), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (failing AND many = 1), 0)::BIGINT AS unique_fails,
         coalesce(sum(g) FILTER (failing AND NOT earlier), 0)::BIGINT AS good_lost,
         coalesce(sum(t) FILTER (failing AND NOT earlier), 0)::BIGINT AS toxic_lost
  FROM joined GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM sums
"""


@query("op12_filter_audit", SQL)
def op12_filter_audit(spark, sf_dir):
    return interaction_audit(failure_sets(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
