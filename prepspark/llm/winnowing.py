"""Document fingerprints by winnowing (DataFrame functions only).

A text is cut into pieces: runs without white space, cut after ``piece_chars`` characters.
Every ``k`` pieces in a row are hashed; of every ``w`` hashes in a row the smallest is chosen,
the rightmost one among equals, and kept with its position.  Guarantee: two texts that share
``w + k - 1`` pieces in a row share a chosen hash, and no match of fewer than ``k`` pieces is
reported.  A text of fewer than ``k`` pieces has one hash of all of them, one of fewer than
``w`` hashes has their minimum; a text without pieces has none.

Hash and position travel in one number, ``hash << 28 | (2**28 - 1 - position)``: the minimum of
such numbers is the smallest hash at its rightmost place, and distinct numbers are distinct
choices.  35 bits of hash remain; two sets of a thousand hashes meet by chance about once in
thirty thousand comparisons.

The next document in ascending id order is found without one task that sees all rows: ids are
cut into ranges at approximate quantiles (any cut gives the same result), rows are ordered
within a range, and the last row of a range takes the first row of the next one.  Texts are
shuffled once, with their fingerprints.

Results for odd input: a null text is empty and has no fingerprint; two empty fingerprints
are alike (1), an empty and another are not (0); null ids come first; rows that repeat an id
follow each other in the order of their texts; extra columns are ignored; an empty table
gives an empty result; a single row is its own next document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, query, settle, table

K = 4
WINDOW = 8
PIECE_CHARS = 16
PLACE_BITS = 28


def fingerprint(text: Column, k: int = K, window: int = WINDOW, piece_chars: int = PIECE_CHARS) -> Column:
    """Chosen (hash, place) numbers of a text in order of place, as ``array<bigint>``."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"[^\x20\x09-\x0D]{{1,{piece_chars}}}"), F.lit(0))
    places = (1 << PLACE_BITS) - 1

    def grams(p: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(p) - k, F.lit(0))),
            lambda i: F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.slice(p, i + 1, F.lit(k))), PLACE_BITS + 1), PLACE_BITS)
            + (F.lit(places) - F.least(i, F.lit(places))).cast("long"),
        )

    def minima(h: Column) -> Column:
        return F.array_distinct(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(h) - window + 1, F.lit(1))),
                lambda i: F.array_min(F.slice(h, i, F.lit(window))),
            )
        )

    empty = F.array().cast("array<bigint>")
    return let(pieces, lambda p: F.when(F.size(p) == 0, empty).otherwise(let(grams(p), minima)))


def hashes(chosen: Column) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(chosen, lambda x: F.shiftright(x, PLACE_BITS)))


def likeness(left: Column, right: Column) -> Column:
    """Jaccard similarity of two hash sets."""
    def share(common: Column) -> Column:
        union = F.size(left) + F.size(right) - common
        return F.when(union == 0, F.lit(1.0)).otherwise(common / union).cast("double")

    return let(F.size(F.array_intersect(left, right)), share)


def _range_of(cuts: list[int], value: Column) -> Column:
    """How many of the sorted cuts are at most ``value``; looks at about 2 * sqrt(len(cuts)) of them."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1
    fine, coarse = (F.array(*map(F.lit, c)).cast("array<bigint>") if c else None for c in (cuts, cuts[step - 1 :: step]))

    def upto(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= value))

    if coarse is None:
        return upto(fine)
    return let(upto(coarse) * step, lambda done: done + upto(F.slice(fine, done + 1, F.lit(step))))


def with_next(rows: DataFrame, derived: dict[str, Column], ranges: int | None = None) -> DataFrame:
    """``rows`` (``id``, ``text``) with the ``derived`` columns, and ``next_<name>`` of ``text`` and of
    each derived column, from the row that follows; the last row is followed by the first."""
    spark = rows.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("id", [i / ranges for i in range(1, ranges)], 10_000)).first()[0] if ranges > 1 else []
    place = F.when(F.col("id").isNull(), F.lit(0)).otherwise(_range_of(sorted(set(cuts or [])), F.col("id")))
    placed = rows.withColumn("range", place)
    # The first row of each range, and which range follows which: at most ``ranges`` rows.
    first = F.min(F.struct(F.col("id").isNotNull().alias("n"), "id", "text"))
    heads = settle(placed.groupBy("range").agg(first.alias("h")).select("range", "h.text"), "next-heads")
    heads = settle(heads.withColumns(derived), "next-heads")
    line = Window.orderBy("range")
    follows = heads.select("range", F.lead("range").over(line).alias("after"), F.min("range").over(Window.partitionBy()).alias("top"))
    follows = follows.select("range", F.coalesce("after", "top").alias("after"))
    names = ["text", *derived]
    head = heads.select(F.col("range").alias("after"), *[F.col(c).alias(f"head_{c}") for c in names])
    head = follows.join(head, "after").drop("after").withColumn("is_head", F.lit(True))
    within = Window.partitionBy("range").orderBy(F.col("id").asc_nulls_first(), "text")
    led = placed.withColumns(derived)
    led = led.withColumns({f"led_{c}": F.lead(c).over(within) for c in names}).join(head, "range", "left")
    # the text is never null, so a null says that the range ends here
    last = F.col("led_text").isNull()
    return led.select(
        "id", *names, *[F.when(last, F.col(f"head_{c}")).otherwise(F.col(f"led_{c}")).alias(f"next_{c}") for c in names]
    )


def fingerprints_with_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """One row per input row: id, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text is the text whose last ``n_chars div 2`` code points are replaced by the
    first as many (or all) of the next document's.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    both = with_next(rows, {"fp": fingerprint(F.col("text"))}, ranges)
    n = F.length("text")
    half = F.expr("length(text) div 2").cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half))
    both = both.select("id", n.cast("long").alias("n_chars"), "fp", "next_fp", edited.alias("edited"))
    found = both.select("id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fp", "next_fp", fingerprint(F.col("edited")).alias("efp"))
    near = let(
        hashes(F.col("fp")),
        lambda own: F.struct(
            let(hashes(F.col("efp")), lambda x: likeness(own, x)).alias("edited"),
            let(hashes(F.col("next_fp")), lambda x: likeness(own, x)).alias("next"),
        ),
    )
    return found.withColumn("near", near).select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", F.col("fp").alias("fingerprint"), F.col("efp").alias("edited_fingerprint"),
        F.col("near.edited").alias("near_edited"), F.col("near.next").alias("near_next"),
    )


def selections(chosen: Column) -> Column:
    """A fingerprint as ``array<struct<hash, place>>``."""
    places = (1 << PLACE_BITS) - 1
    return F.transform(
        chosen,
        lambda x: F.struct(F.shiftright(x, PLACE_BITS).alias("hash"), (F.lit(places) - x.bitwiseAND(F.lit(places))).cast("int").alias("place")),
    )


@query("op5_fingerprints")
def op5_fingerprints(spark, sf_dir):
    return fingerprints_with_neighbours(table(spark, sf_dir, "documents"))
