"""Exact duplicates by progressive refinement (DataFrame functions only).

Texts are equal when they are identical after every run of white space became one
space; a null text is empty.  Three keys are tried in turn, each finer and dearer:

1. the length of the normalised text,
2. a hash of its first ``prefix_chars`` characters, for lengths that occur twice,
3. SHA-256 of the whole text, for (length, prefix) pairs that occur twice.

A row leaves as a group of its own as soon as a key is unique to it.  The keys that
occur twice are passed to the next scan as a table of at most ``2 ** filter_bits``
hash buckets; two keys in one bucket only make a row stay longer, never wrong.  So the
broadcast has a fixed bound (64 K buckets of 4 bytes by default), texts are never
shuffled, and only rows of 100 bytes are.  Groups are counted with map-side
aggregation, so a group that holds a third of all rows is one row per task there.

Results for odd input: an empty table gives an empty result; extra columns are
ignored; null ids take part (a group's ``keep_id`` is its smallest non-null id, and a
null id is kept only where all ids of the group are null); rows that repeat an id
count each in ``group_size`` and get the same answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, query, settle, table


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, " ")


def _twice(keys: DataFrame, buckets: int) -> DataFrame:
    """Hash buckets that hold two rows or more: at most ``buckets`` rows."""
    return (
        keys.groupBy(F.pmod(F.col("key"), F.lit(buckets)).cast("int").alias("bucket"))
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("bucket")
    )


def _among(rows: DataFrame, twice: DataFrame, buckets: int) -> DataFrame:
    """Rows whose key falls in one of the buckets; the table's size is bounded by ``buckets``."""
    hit = F.pmod(F.col("key"), F.lit(buckets)).cast("int") == F.col("bucket")
    return rows.join(F.broadcast(twice), hit, "left_semi")


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = 256,
    filter_bits: int = 16,
    digests: bool = False,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``.

    ``digests=True`` adds ``text_sha256`` of every row; then the last key is computed for
    all rows, else only for those that the first two keys leave.
    """
    buckets = 1 << filter_bits
    text = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"))
    length = F.xxhash64(F.length("norm"))
    prefix = F.xxhash64(F.length("norm"), F.substring("norm", 1, prefix_chars))

    by_length = settle(_twice(text.select(length.alias("key")), buckets), "dedup-length")
    same_length = _among(text.withColumn("key", length), by_length, buckets)
    by_prefix = settle(_twice(same_length.select(prefix.alias("key")), buckets), "dedup-prefix")

    full = F.sha2(F.col("norm"), 256)
    flags = (
        text.withColumn("b1", F.pmod(length, F.lit(buckets)).cast("int"))
        .withColumn("b2", F.pmod(prefix, F.lit(buckets)).cast("int"))
        .join(F.broadcast(by_length.select(F.col("bucket").alias("b1"), F.lit(True).alias("f1"))), "b1", "left")
        .join(F.broadcast(by_prefix.select(F.col("bucket").alias("b2"), F.lit(True).alias("f2"))), "b2", "left")
    )
    survives = F.col("f1").isNotNull() & F.col("f2").isNotNull()
    slim = settle(
        flags.select(
            "id",
            survives.alias("open"),
            (full if digests else F.when(survives, full)).alias("sha"),
            F.xxhash64("norm").alias("mark"),
        ),
        "dedup-rows",
    )
    groups = (
        slim.where("open").groupBy("sha").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    )
    found = slim.join(groups, "sha", "left")
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("first"))
    return found.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        *([F.col("sha").alias("text_sha256")] if digests else []),
        F.col("mark").alias("text_mark"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row goes when its id and its text's hash are those of a row that is not kept; rows
    without an id cannot be named and stay.  The list of rows that go grows with the corpus,
    so it is not broadcast; the documents are shuffled once.
    """
    found = exact_duplicates(docs, id_col, text_col, **options)
    gone = found.where("NOT kept").select(F.col(id_col).alias("__gone"), F.col("text_mark").alias("__mark"))
    gone = settle(gone.where("__gone IS NOT NULL").distinct(), "dedup-gone")
    same = (F.col(id_col) == F.col("__gone")) & (F.xxhash64(normalised(F.col(text_col))) == F.col("__mark"))
    return docs.join(gone.hint("merge"), same, "left_anti")


SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS s FROM documents
), g AS (SELECT s, min(doc_id) AS keep_id, count(*) AS n FROM d GROUP BY s)
SELECT doc_id, keep_id, n::BIGINT AS group_size, doc_id = keep_id AS kept, s AS text_sha256
FROM d JOIN g USING (s)
"""


@query("op3_exact_dedup", SQL)
def op3_exact_dedup(spark, sf_dir):
    return exact_duplicates(table(spark, sf_dir, "documents"), digests=True).drop("text_mark")
