"""Benchmark decontamination over a distributed positional inverted index.

Words are maximal runs of ``[0-9a-z]`` and non-ASCII characters after A-Z became a-z.

1. ``build_index`` stores the postings of every word of every document.  The index is cut by
   documents into segments of about ``SEGMENT_WORDS`` words; within a segment positions count
   on from document to document, with an unused position between two documents.  A row is one
   term of one segment: its number of occurrences and its sorted positions as differences.
   Nothing is shuffled; a task writes the segments of its own documents.
2. Benchmark items are cut into windows of ten consecutive words (a shorter item is one
   window).  They are the query set and run in blocks of ``BLOCK_WORDS`` words against the
   whole index, so that what a task is sent has a bound however large the benchmark is.
3. The index's counts give each window its terms from the rarest to the most frequent one; a
   window with a term that no document holds ends here.
4. Within a segment the rarest term's list, less the term's offset in the window, gives the
   candidate starts.  Each further term's list, adjusted by its own offset, is intersected with
   them.  All windows of the block go through this together.
5. ``slop`` > 0 asks for proximity instead of the exact phrase: each term may stand up to
   ``slop`` words away from where the rarest term puts it.

A segment is the unit of recovery and of memory, so no key and no frequent word can fill a
task: a word that fills a third of all texts has equally long lists in all segments.

Results for odd input: null or wordless texts have no words and are never hit; null or
wordless items have no window; repeated items (same id) count once; a null item id counts as
one item and prints as nothing; rows that repeat a doc_id are separate documents; one very long
text makes a segment of its own; empty tables give empty or unhit results; extra columns are
ignored.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count as counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import query, settle, slices, table

SEGMENT_WORDS = 1 << 20
BLOCK_WORDS = 100_000
WINDOW = 10
#: Every byte of UTF-8 text as a letter of a word or as a gap.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in order."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def _segment_rows(segment: int, ids: list, sizes: list[int], codes: list[np.ndarray], terms: list[bytes], kind) -> pa.RecordBatch:
    """The rows of one segment: one for its documents (empty term), one per term."""
    sizes_ = np.array(sizes, np.int64)
    starts = np.cumsum(sizes_ + 1) - sizes_ - 1
    places = np.repeat(starts - (np.cumsum(sizes_) - sizes_), sizes_) + np.arange(sizes_.sum())
    keys = np.concatenate([*codes, np.empty(0, np.int64)]) << 32 | places
    keys.sort()
    term, place = keys >> 32, (keys & 0xFFFFFFFF).astype(np.int32)
    n = np.bincount(term, minlength=len(terms)).astype(np.int32)
    first = np.cumsum(n) - n
    gaps = np.diff(place, prepend=np.int32(0))
    if len(gaps):
        gaps[first] = place[first]
    blob = sizes_.astype("<i4").tobytes() + gaps.astype("<i4").tobytes()
    ends = np.concatenate([[0], 4 * len(sizes) + 4 * np.concatenate([[0], np.cumsum(n)])]).astype("<i4")
    at = pa.Array.from_buffers(pa.binary(), len(terms) + 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(blob)])
    rows = len(terms) + 1
    none = [None] * len(terms)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(rows, segment)),
            pa.array([b"", *terms], pa.binary()),
            pa.array(np.concatenate([[len(sizes)], n]).astype(np.int32)),
            at,
            pa.array([ids, *none], pa.list_(kind)),
            pa.array([sizes, *none], pa.list_(pa.int32())),
        ],
        ["segment", "term", "n", "at", "ids", "sizes"],
    )


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The stored index: ``segment``, ``term``, ``n``, ``at`` (position differences), ``ids``, ``sizes``.

    The row of the empty term holds a segment's documents: their ids and their word counts
    (in ``sizes``, and as bytes in ``at``).
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        part, made = TaskContext.get().partitionId(), 0
        ids, sizes, codes, known, total = [], [], [], defaultdict(counter().__next__), 0
        kind = None
        for batch in slices(batches, 64):
            kind = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                ids.append(key)
                sizes.append(len(words))
                codes.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                total += len(words) + 1
                if total >= segment_words:
                    yield _segment_rows((part << 32) + made, ids, sizes, codes, list(known), kind)
                    made += 1
                    ids, sizes, codes, known, total = [], [], [], defaultdict(counter().__next__), 0
        if ids:
            yield _segment_rows((part << 32) + made, ids, sizes, codes, list(known), kind)

    kind = source.schema["id"].dataType.simpleString()
    rows = source.mapInArrow(run, f"segment bigint, term binary, n int, at binary, ids array<{kind}>, sizes array<int>")
    return settle(rows, "index", compression="zstd")


def indexed_documents(index: DataFrame) -> DataFrame:
    """(``segment``, ``place``, ``id``, ``n_words``): every document of the index."""
    held = index.where(F.col("term") == F.lit(b"")).select("segment", "sizes", F.posexplode("ids").alias("place", "id"))
    return held.select("segment", "place", "id", F.col("sizes")[F.col("place")].cast("bigint").alias("n_words"))


def _blocks(items: DataFrame, id_col: str, text_col: str, block_words: int):
    """The items in blocks, each an iterable of (id, words), of about ``block_words`` words."""
    source = items.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    size = source.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + size // (4 * block_words)
    for k in range(blocks):
        rows = source.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k)
        found = [(row["id"], words_of(row["text"])) for row in rows.toLocalIterator()]
        if found := [(i, w) for i, w in found if w]:
            yield found


def _plan(found: list, counts: dict[bytes, int], width: int):
    """Windows whose terms all occur: (terms used, term per window and step, offset per step, item per window)."""
    terms: dict[bytes, int] = {}
    steps, offsets, owners = [], [], []
    for owner, (_, words) in enumerate(found):
        length = min(width, len(words))
        often = [counts.get(w, 0) for w in words]
        for s in range(len(words) - length + 1):
            if 0 in often[s : s + length]:
                continue
            order = sorted(range(length), key=lambda k, s=s: (often[s + k], k))
            steps.append([terms.setdefault(words[s + k], len(terms)) for k in order] + [-1] * (width - length))
            offsets.append(order + [0] * (width - length))
            owners.append(owner)
    shape = (len(steps), width)
    return list(terms), np.array(steps, np.int64).reshape(shape), np.array(offsets, np.int64).reshape(shape), np.array(owners, np.int64)


def _intersect(lists: dict[int, np.ndarray], n_terms: int, steps: np.ndarray, offsets: np.ndarray, slop: int):
    """Matches of all windows in one segment: (window, first position, end)."""
    counts = np.zeros(n_terms + 1, np.int64)
    for t, at in lists.items():
        counts[t] = len(at)
    counts[n_terms] = 1  # stands for the steps that shorter windows lack (-1)
    alive = np.flatnonzero((counts[steps] > 0).all(axis=1))
    order = sorted(lists)
    base = np.zeros(n_terms + 1, np.int64)
    base[order] = np.cumsum(counts[order]) - counts[order]
    postings = np.concatenate([(np.int64(t) << 32) + lists[t] for t in order] + [np.empty(0, np.int64)])
    rare = steps[alive, 0]
    n = counts[rare]
    window = np.repeat(alive, n)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = (postings[np.repeat(base[rare], n) + inside] & 0xFFFFFFFF) - offsets[window, 0]
    low = start + offsets[window, 0]
    high = low + 1
    for k in range(1, steps.shape[1]):
        t, want = steps[window, k], start + offsets[window, k]
        key = (t << 32) + want
        spot = np.searchsorted(postings, key - slop)
        there = postings[np.minimum(spot, len(postings) - 1)] if len(postings) else key
        keep = (t < 0) | ((want + slop >= 0) & (spot < len(postings)) & (there <= key + slop) & (there >> 32 == t))
        place = np.where(t < 0, low, there & 0xFFFFFFFF)
        window, start, low, high, place = window[keep], start[keep], low[keep], high[keep], place[keep]
        low, high = np.minimum(low, place), np.maximum(high, place + 1)
    return window, low, high


def _hits(sizes: np.ndarray, window, low, high, owners: np.ndarray):
    """Per hit document: its place, its items and its merged spans, relative to its first word."""
    starts = np.cumsum(sizes + 1) - sizes - 1
    doc = np.searchsorted(starts, low, "right") - 1
    same = high <= starts[doc] + sizes[doc]  # a proximity match may not reach into the next document
    doc, window, low, high = doc[same], window[same], low[same], high[same]
    order = np.lexsort((high, low, doc))
    doc, window, low, high = doc[order], window[order], low[order], high[order]
    for d, at in zip(*np.unique(doc, return_index=True)):
        end = np.searchsorted(doc, d, "right")
        spans: list[list[int]] = []
        for a, b in zip((low[at:end] - starts[d]).tolist(), (high[at:end] - starts[d]).tolist()):
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], b)
            else:
                spans.append([a, b])
        yield int(d), np.unique(owners[window[at:end]]).tolist(), spans


def search(
    index: DataFrame,
    items: DataFrame,
    id_col: str = "item_id",
    text_col: str = "text",
    width: int = WINDOW,
    slop: int = 0,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Hit documents: ``segment``, ``place``, ``items`` (ids of items with a match), ``spans`` ([from, to) in words).

    One row per document and block of items.
    """
    spark = index.sparkSession
    kind = items.schema[id_col].dataType.simpleString()
    schema = f"segment bigint, place int, items array<{kind}>, spans array<array<int>>"
    made = to_arrow_schema(StructType.fromDDL(schema))
    results = None
    for found in _blocks(items, id_col, text_col, block_words):
        vocabulary = spark.createDataFrame([(w,) for w in sorted({bytes(w) for _, words in found for w in words})], "term binary")
        counted = index.select("term", "n").join(F.broadcast(vocabulary), "term").groupBy("term").agg(F.sum("n").alias("n"))
        counts = {bytes(r["term"]): r["n"] for r in counted.collect()}  # at most a block's words
        terms, steps, offsets, owners = _plan(found, counts, width)
        if not len(steps):
            continue
        names = [i for i, _ in found]

        def run(batches, n_terms=len(terms), steps=steps, offsets=offsets, owners=owners, names=names):
            def results_of(segment, lists):
                sizes = lists.pop(-1)
                hits = list(_hits(sizes, *_intersect(lists, n_terms, steps, offsets, slop), owners))
                return pa.RecordBatch.from_pydict(
                    {
                        "segment": [segment] * len(hits),
                        "place": [d for d, _, _ in hits],
                        "items": [[names[o] for o in own] for _, own, _ in hits],
                        "spans": [spans for _, _, spans in hits],
                    },
                    schema=made,
                )

            held, lists = None, {}
            for batch in batches:
                for segment, t, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                    if segment != held and held is not None:
                        yield results_of(held, lists)
                        lists = {}
                    held = segment
                    gaps = np.frombuffer(at.as_buffer(), "<i4").astype(np.int64)
                    lists[t] = gaps if t < 0 else np.cumsum(gaps)
            if held is not None:
                yield results_of(held, lists)

        wanted = spark.createDataFrame([(b"", -1), *((w, k) for k, w in enumerate(terms))], "term binary, t int")
        rows = index.select("segment", "term", "at").join(F.broadcast(wanted), "term").select("segment", "t", "at")
        block = settle(rows.repartition("segment").sortWithinPartitions("segment").mapInArrow(run, schema), "index-hits")
        results = block if results is None else results.unionByName(block)
    return spark.createDataFrame([], schema) if results is None else results


def _covered(spans: Column) -> Column:
    """Number of words in the union of spans ([from, to), in any order)."""
    state = F.struct(F.lit(0).alias("reach"), F.lit(0).alias("n"))

    def add(s: Column, span: Column) -> Column:
        begin = F.greatest(span[0], s["reach"])
        return F.struct(F.greatest(span[1], s["reach"]).alias("reach"), (s["n"] + F.greatest(span[1] - begin, F.lit(0))).alias("n"))

    return F.aggregate(F.array_sort(spans), state, add, lambda s: s["n"])


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    **options,
) -> DataFrame:
    """One row per document: ``n_words``, ``n_hit``, ``items`` (sorted ids as strings), ``spans``."""
    index = build_index(docs, doc_id, doc_text)
    hits = search(index, items, item_id, item_text, **options)
    hits = hits.groupBy("segment", "place").agg(  # a row per block of the query set
        F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("spans")).alias("spans")
    )
    names = F.transform("items", lambda i: F.coalesce(i.cast("string"), F.lit("")))
    found = indexed_documents(index).join(hits.hint("merge"), ["segment", "place"], "left")
    return found.select(
        F.col("id").alias(doc_id),
        "n_words",
        F.coalesce(_covered(F.col("spans")), F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.array_sort(F.array_distinct(names)), F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.array_sort("spans"), F.array().cast("array<array<int>>")).alias("spans"),
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(greatest(len(w) - 9, 1)),
         lambda i: array_to_string(w[i + 1 : i + 10], ' '))) AS g FROM b WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, unnest(range(len(w) - n + 1)) AS s, unnest(list_transform(range(len(w) - n + 1),
         lambda i: array_to_string(w[i + 1 : i + n], ' '))) AS g FROM d, sizes WHERE len(w) >= n
), hits AS (SELECT doc_id, item_id, s, n FROM grams JOIN windows USING (n, g)),
words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) FROM hits) GROUP BY 1),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS names FROM hits GROUP BY 1
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op11_decontaminate", SQL)
def op11_decontaminate(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
