"""Mixing sources to target weights by a low-discrepancy slot schedule.

1. ``source_targets``: weights share ``budget`` (150 %) of all words; a target stops at
   ``max_epochs`` (2) times its source's size and the excess goes to the others by weight.
   The fixed point is ``min(cap, level * weight)`` for one common level.
2. Each source's documents are shuffled by a hash of their id and laid end to end; this
   tape is cut into blocks of ``block_words`` words (the last one of a source is shorter).
3. ``schedule``: slot ``t`` gets the van der Corput point of ``t`` (the bits of ``t``
   mirrored behind the binary point).  The source is the one whose interval of the
   cumulative target shares holds the point.  A slot's rank among its source's slots says
   which block it takes: ranks run round the tape, so a second pass starts only after the
   first is complete.
4. Slots are joined to blocks and the words that each document gives are added up.

The van der Corput sequence leaves a source at most a few slots off its share.  Slots
beyond a source's last needed rank are dropped and missing ranks are appended at the end,
and the last slot takes only the words that are left, so that the words taken of a source
are its target rounded.  All steps are functions of ids and sizes: reruns agree.

Nothing depends on one source fitting in a task: running sums are taken within
(source, hash range) and ranks within (source, run of slots); what these windows pass on
is one row per range.  Two tables have one row per source, as a mixture's configuration
has; one window sorts them.

Results for odd input: an empty table gives an empty result; extra columns are ignored;
a null text has size 0 and gives 0 words; a null source is a source of its own, last in
order; null ids share one hash and are ordered by size; rows that repeat an id are rows
of their own, each with its share; where all texts are empty all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, query, settle, table

#: Bits of a slot number that are mirrored; 2**48 slots of 1024 words are beyond any corpus.
POINT_BITS = 48


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), budget: float = 1.5, max_epochs: float = 2.0
) -> DataFrame:
    """(source, source_size) -> the same with ``place`` and ``target``, one row per source.

    Weights repeat over the sources in the order of their code points, null last.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    listed = sizes.withColumn("place", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int") + 1)
    )
    # Sources reach their cap in the order of cap / weight.  With the first k at their caps the level is
    # (budget - sum of those caps) / (sum of the other weights); it holds from the first source that stays below.
    capped = listed.withColumn("cap", F.lit(max_epochs) * F.col("source_size")).withColumn(
        "aim", F.lit(budget) * F.sum("source_size").over(everything)
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("aim") - F.coalesce(F.sum("cap").over(by_ratio), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0.0))
    )
    below = capped.withColumn("level", level).withColumn("open", F.col("cap") / F.col("weight") > F.col("level"))
    first = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("place"), F.col("level")))).over(
        everything
    )["level"]
    target = F.when(first.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), first * F.col("weight")))
    return below.select("source", "source_size", "place", target.cast("double").alias("target"))


def _point(slot: Column) -> Column:
    """Van der Corput point of a slot number in [0, 1), exact in a double."""
    mirrored = F.conv(F.reverse(F.lpad(F.bin(slot), POINT_BITS, "0")), 2, 10).cast("double")
    return mirrored / F.lit(float(2**POINT_BITS))


def schedule(targets: DataFrame, block_words: int = 1024, run: int = 1 << 16) -> DataFrame:
    """Slots of the mix: ``slot``, ``place`` (the source's), ``rank``, ``block``, ``words``.

    ``targets`` needs ``place``, ``source_size``, ``target``.  ``words`` is what the slot
    takes from the start of its block; ``run`` slots are ranked in one window group.
    """
    spark = targets.sparkSession
    goal = F.floor(F.col("target") + 0.5).cast("long")
    needed = targets.select("place", "source_size", goal.alias("goal")).where("goal > 0")
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")  # of one pass over the tape
    passes = F.expr("goal div source_size")
    rest = F.col("goal") - passes * F.col("source_size")
    needed = needed.select(
        "place", "source_size", "goal", blocks.alias("blocks"),
        (passes * blocks + F.ceil(rest / block_words)).cast("long").alias("slots"),
    )
    needed = settle(needed, "mix-needed")
    total, sources = needed.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
    # The interval of a source, cut along equal cells: an equality join finds the source of a point.
    cells = 4 * max(1, sources)
    upto = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    spans = needed.withColumn("high", F.sum("slots").over(upto) / F.lit(float(max(1, total)))).withColumn(
        "low", F.coalesce(F.lag("high").over(Window.orderBy("place")), F.lit(0.0))
    )
    spans = spans.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1))))
    ).select("cell", "low", "high", "place")
    slots = spark.range(total).select(F.col("id").alias("slot"), _point(F.col("id")).alias("point"))
    slots = slots.withColumn("cell", F.floor(F.col("point") * cells))
    drawn = slots.join(spans, "cell").where("point >= low AND point < high").select("slot", "place")
    drawn = drawn.withColumn("part", F.expr(f"slot div {run}"))
    # Rank within a source: slots before this run, then the order within the run.
    counts = drawn.groupBy("place", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "mix-runs")
    inside = Window.partitionBy("place", "part").orderBy("slot")
    ranked = drawn.withColumn("k", F.row_number().over(inside) - 1).join(offsets, ["place", "part"])
    ranked = ranked.select("slot", "place", (F.col("k") + F.col("before")).alias("rank"))
    ranked = ranked.join(needed.select("place", "slots"), "place").where("rank < slots").drop("slots")
    # Ranks that the sequence did not reach come after all its slots.
    reached = offsets.groupBy("place").agg(F.sum("n").alias("reached"))
    short = needed.join(reached, "place", "left").withColumn("reached", F.coalesce("reached", F.lit(0)))
    tail = short.where("reached < slots").select(
        "place", F.explode(F.sequence(F.col("reached"), F.col("slots") - 1)).alias("rank")
    )
    tail = tail.select((F.lit(total) + F.col("rank")).alias("slot"), "place", "rank")
    both = ranked.unionByName(tail).join(needed, "place")
    start = F.expr("rank div blocks") * F.col("source_size") + (F.col("rank") % F.col("blocks")) * block_words
    size = F.least(F.lit(block_words), F.col("source_size") - (F.col("rank") % F.col("blocks")) * block_words)
    return both.select(
        "slot", "place", "rank", (F.col("rank") % F.col("blocks")).alias("block"),
        F.least(size, F.col("goal") - start).cast("long").alias("words"),
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    budget: float = 1.5,
    max_epochs: float = 2.0,
    block_words: int = 1024,
    rows_per_range: int = 20_000,
) -> DataFrame:
    """One row per input row: id, ``source``, ``size``, ``source_size``, ``target``, ``taken``.

    ``taken`` counts the words that the mix takes of the document, repeats counted.
    ``rows_per_range`` only bounds a window group; the result does not depend on it.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    rows = settle(rows, "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sizes = settle(sizes, "mix-sizes")
    targets = settle(source_targets(sizes.drop("rows"), weights, budget, max_epochs), "mix-targets")
    info = sizes.join(targets.select(F.col("source").alias("s"), "place", "target"), F.col("source").eqNullSafe(F.col("s")))
    info = info.drop("s").withColumnRenamed("source", "s")
    rows = rows.join(info, F.col("source").eqNullSafe(F.col("s"))).drop("s")

    # Shuffled order is the order of a 31-bit hash; ranges of the hash follow one another.
    digest = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))
    mixed = F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), 1)
    ranges = F.ceil(F.col("rows") / rows_per_range)
    rows = rows.withColumn("mixed", mixed).withColumn("range", F.floor(F.col("mixed") * ranges / float(1 << 31)))
    within = Window.partitionBy("place", "range").orderBy("mixed", "id", "size")
    sums = rows.groupBy("place", "range").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("place").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("place", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    laid = rows.withColumn("end", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    laid = laid.join(sums, ["place", "range"]).withColumn("start", F.col("before") + F.col("end") - F.col("size"))
    keys = ["id", "source", "place", "size", "source_size", "target"]
    laid = laid.select(*keys, "start")

    first, last = F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}")
    pieces = laid.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    pieces = pieces.withColumn("from", F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0)))
    pieces = pieces.withColumn("to", F.least(F.col("start") + F.col("size") - F.col("block") * block_words, F.lit(block_words)))
    uses = schedule(targets, block_words).groupBy("place", "block", "words").agg(F.count("*").alias("times"))
    given = F.greatest(F.least(F.col("to"), F.col("words")) - F.col("from"), F.lit(0)) * F.col("times")
    taken = pieces.join(uses, ["place", "block"], "left").groupBy(*keys, "start")
    taken = taken.agg(F.coalesce(F.sum(given), F.lit(0)).cast("long").alias("taken"))
    empty = laid.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return taken.unionByName(empty).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "taken"
    )


def mix_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The documents of the mix with all their columns, whole: a document comes as often as
    its words are taken, rounded (the one that the end of a source's tape cuts comes once
    more if at least half of it is taken).  Documents without words are not in a mix."""
    found = mix_sources(docs, id_col, text_col, source_col, **options)
    copies = F.round(F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("int")
    found = found.select(F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), "size", copies.alias("__copies"))
    found = settle(
        found.groupBy("__id", "__source", F.col("size").alias("__size"))
        .agg(F.max("__copies").alias("__copies"))
        .where("__copies > 0"),
        "mix-copies",
    )
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & F.col(source_col).eqNullSafe(F.col("__source")) & (size == F.col("__size"))
    picked = docs.join(found.hint("merge"), same).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return picked.select(*docs.columns)


SQL = r"""
WITH r AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT // 2 AS mixed
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM r GROUP BY source
), w AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS aim
  FROM s
), l AS (
  SELECT *, (aim - coalesce(sum(cap) OVER b, 0.0::DOUBLE))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0::DOUBLE)) AS level
  FROM w WINDOW b AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT level FROM l WHERE cap / weight > level ORDER BY cap / weight, place LIMIT 1
), t AS (
  SELECT source, source_size, CASE WHEN (SELECT count(*) FROM f) = 0 THEN cap
         ELSE least(cap, (SELECT level FROM f) * weight) END AS target
  FROM w
), o AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, r.source, floor(t.target + 0.5)::BIGINT AS goal,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY r.mixed, r.doc_id, r.size
                           ROWS UNBOUNDED PRECEDING)::BIGINT - r.size AS start
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, source,
       CASE WHEN source_size = 0 THEN 0 ELSE goal // source_size * size
            + greatest(least(start + size, goal % source_size) - start, 0) END::BIGINT AS taken
FROM o
"""


@query("op10_source_mix", SQL)
def op10_source_mix(spark, sf_dir):
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")
