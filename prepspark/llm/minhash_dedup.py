"""Near duplicates: MinHash with tensored banding, links confirmed on full shingle sets.

Words are runs without white space after A-Z became a-z; a document's set holds its
distinct shingles of five words (the whole sequence where there are fewer).  Two documents
are linked where ``100 * |A & B| >= 75 * |A | B|``.

1. One scan gives each document its set's digest and ``4 * m`` minima.  Documents with the
   same set are one node from here on, so exact copies cost nothing.
2. Banding is tensored: the minima form two collections of ``m`` pairs, U and V, and table
   (i, j) is keyed by U_i and V_j.  ``m * m`` tables of four minima need ``4 * m`` minima
   instead of ``4 * m * m``.  A link at 0.75 is missed in all tables with a probability of
   ``2 * (1 - 0.75**2) ** m``: 1e-4 for m = 12, and 1e-6 at 0.81.  U_i buckets with a single
   node are left out before the tables are built.
3. In a bucket every node is compared with one leader, never all with all: the node that meets
   most others in the buckets of single pairs, as the text from which copies were made does.
   The leader with which a node shares most buckets is verified; that joins most of a group.
4. Nodes of buckets that still hold several components go through an exact join
   (``prefix_join``): they meet only in their rarest shingles, and only if the positions of these
   still admit the similarity.  Texts that share a passage, or that are far copies of one text,
   have too many shingles of their own and never meet, so the work grows with the nodes, not
   with the pairs of a bucket.  In rounds nodes meet the most promising nodes of each other
   component, then more, at last all; what a round joined meets no more.  No cap holds back a pair.
5. Links are verified by intersecting the two full sets.
6. Components by alternating stars; the smallest doc_id of a component names it.

Tables that grow with the corpus are never broadcast, however small they are at the time: every
join by node, id or bucket is a merge join at every size.

Hot groups: no step gathers a bucket in a task.  Leaders are aggregated on the map side, and the
joins by bucket and by shingle can be split by the engine.

Results for odd input: null or blank text is an empty set, linked with nothing, its own
component; null ids take part and a component is named by its smallest non-null id (null if
there is none); rows that repeat an id are separate rows whose texts are linked by content;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, query, releasing, settle, slices, table
from .components import connected_components
from .prefix_join import candidates, mixed_members, shared_prefixes

SHINGLE = 5
BANDS = 12
_U64 = np.uint64
CACHED_WORDS = 200_000
#: Nodes of a component that a node of another one meets in the first round.
FIRST_MET = 4


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles.

    Lower-casing and splitting bytes touches ASCII only, as the definition asks.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, _U64)
    known = held("words", dict)
    if len(known) > CACHED_WORDS:
        known.clear()
    ids = []
    for w in words:
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh3_64_intdigest(w)
        ids.append(h)
    h = np.array(ids, _U64)
    n = max(1, len(h) - width + 1)
    s = np.full(n, min(width, len(h)), _U64)
    for k in range(min(width, len(h))):
        s = (s ^ h[k : k + n]) * _U64(0x9E3779B97F4A7C15)
        s ^= s >> _U64(32)
    return np.unique(s * _U64(0xD6E8FEB86659FD93) ^ s >> _U64(29))


def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 2**63, count).astype(_U64), rng.integers(0, 2**63, count).astype(_U64) << _U64(1) | _U64(1)


def signature(shingles: np.ndarray, count: int) -> bytes:
    """``count`` 32-bit minima; a long set is read in pieces."""
    xor, odd = _multipliers(count)
    low = np.full(count, 2**64 - 1, _U64)
    for i in range(0, len(shingles), 1 << 14):
        np.minimum(low, ((shingles[i : i + (1 << 14), None] ^ xor) * odd).min(axis=0), out=low)
    return (low >> _U64(32)).astype("<u4").tobytes()


def signatures(docs: DataFrame, id_col: str, text_col: str, count: int) -> DataFrame:
    """id, ``n_shingles``, ``node`` (digest of the set) and ``sig`` per row; null for an empty set."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in slices(batches):
            sizes, nodes, sigs = [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py())
                sizes.append(len(s))
                nodes.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sigs.append(signature(s, count) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(sigs, pa.binary())],
                ["id", "n_shingles", "node", "sig"],
            )

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(releasing(run), f"id {kind}, n_shingles bigint, node binary, sig binary")


def _pair(sig: str, k) -> F.Column:
    """The k-th pair of minima: eight bytes."""
    return F.substring(F.col(sig), 1 + 8 * k, 8) if isinstance(k, int) else F.substr(F.col(sig), 1 + 8 * k, F.lit(8))


def tables(nodes: DataFrame, m: int) -> DataFrame:
    """Rows (``bucket``, ``node``, ``weight``) of the tensored tables, of nodes that share a pair of U with another one.

    ``weight`` is the number of nodes in the buckets of single pairs that hold the node.
    """
    firsts = nodes.select("node", F.posexplode(F.array(*[_pair("sig", i) for i in range(m)])).alias("i", "u"))
    shared = firsts.groupBy("i", "u").agg(F.count("*").alias("n")).where("n > 1")
    met = firsts.join(shared, ["i", "u"]).groupBy("node").agg(F.collect_set("i").alias("own"), F.sum("n").alias("weight"))
    i, j = F.col("i"), F.col("j")
    rows = (
        met.join(nodes.select("node", "sig").hint("merge"), "node")
        .select("node", "sig", "weight", F.explode("own").alias("i"))
        .select("node", "sig", "weight", "i", F.explode(F.array(*map(F.lit, range(m)))).alias("j"))
        .select(F.xxhash64("i", "j", _pair("sig", i), _pair("sig", j + m)).alias("bucket"), "node", "weight")
    )
    return rows


def _stars(rows: DataFrame) -> DataFrame:
    """A link (a, b) per node b: to the leader a with which it shares most buckets."""
    lead = F.max(F.struct("weight", "node")).alias("lead")
    leaders = rows.groupBy("bucket").agg(lead, F.count("*").alias("n")).where("n > 1")
    links = rows.join(leaders.select("bucket", F.col("lead.node").alias("a")), "bucket").where("a <> node")
    met = links.groupBy("a", F.col("node").alias("b")).agg(F.count("*").alias("n"))
    return met.groupBy("b").agg(F.max_by("a", F.struct("n", "a")).alias("a")).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("y"))
    left = left.join(pairs.select("a").distinct().hint("merge"), "a", "left_semi")
    both = pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a").select("a", "b", "x", "y")

    def run(batches):
        known: tuple[bytes, np.ndarray] = (b"", np.empty(0, _U64))
        for batch in slices(batches):
            keep = []
            for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if a != known[0]:
                    known = (a, shingle_set(x.as_py()))
                other = shingle_set(y.as_py())
                common = len(np.intersect1d(known[1], other, assume_unique=True))
                keep.append(100 * common >= percent * (len(known[1]) + len(other) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return both.mapInArrow(releasing(run), "a binary, b binary")


def _texts(docs: DataFrame, rows: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, text): one text of each wanted node, found by the id of its first row."""
    first = rows.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("id").alias("id"), F.min("n_shingles").alias("n"))
    first = settle(first.select("id", "node"), "near-wanted")
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text"))
    found = source.join(first.hint("merge"), F.col("__id").eqNullSafe(F.col("id"))).select("node", "text")

    def run(batches):  # an id may stand on several texts: only the node's own stays
        for batch in slices(batches):
            keep = [
                hashlib.blake2b(shingle_set(t.as_py()).tobytes(), digest_size=16).digest() == n
                for n, t in zip(batch.column(0).to_pylist(), batch.column(1))
            ]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return found.mapInArrow(releasing(run), "node binary, text string")


def _with_roots(frame: DataFrame, roots: DataFrame, *names: str) -> DataFrame:
    """``frame`` with ``<name>_root`` of each named column; a node without a link is its own root."""
    for name in names:
        r = roots.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
        frame = frame.join(r.hint("merge"), name, "left").withColumn(f"{name}_root", F.coalesce(f"{name}_root", name))
    return frame


def _joined(roots: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``roots`` after the verified ``links`` (a, b) of nodes were added."""
    ends = _with_roots(links, roots, "a", "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
    merged = settle(connected_components(ends).select(F.col("node").alias("root"), F.col("root").alias("top")), f"{name}-merged")
    alone = merged.select(F.col("root").alias("node")).join(roots.select("node").hint("merge"), "node", "left_anti")
    every = roots.select("node", "root").unionByName(alone.withColumn("root", F.col("node")))
    found = every.join(merged.hint("merge"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return settle(found, name)


def _apart(frame: DataFrame) -> DataFrame:
    """Rows of buckets that hold nodes of several components."""
    mixed = frame.groupBy("bucket").agg(F.min("node_root").alias("p"), F.max("node_root").alias("q")).where("p <> q")
    return frame.join(mixed.select("bucket"), "bucket", "left_semi")


def _linked(rows: DataFrame, roots: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``roots`` after all pairs of different components that meet in ``rows`` (``shared_prefixes``) were verified.

    A round lets a node meet the first nodes of every other component, 64 times as many as the round before;
    what it joins meets no more.  The last round lets all nodes of the components that are left meet.
    """
    upto = FIRST_MET
    while True:
        shared = mixed_members(_with_roots(rows, roots, "node").withColumnRenamed("node_root", "root"))
        most = shared.agg(F.max("place")).first()[0]
        if most is None:
            return roots
        pairs = settle(candidates(shared, percent, upto), "near-pairs")
        links = settle(_verified(pairs, texts, percent), "near-links")
        if not links.isEmpty():
            roots = _joined(roots, links, "near-roots")
        if most <= upto:
            return roots
        upto *= 64


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, bands: int = BANDS
) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``."""
    count = 4 * bands
    rows = settle(signatures(docs, id_col, text_col, count), "near-rows")
    classes = rows.where("node IS NOT NULL").groupBy("node").agg(F.first("sig").alias("sig"), F.first("n_shingles").alias("size"), F.min("id").alias("least"))
    nodes = settle(classes, "near-nodes")
    filled = settle(tables(nodes, bands), "near-tables")

    stars = settle(_stars(filled), "near-stars")
    wanted = filled.join(filled.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "bucket", "left_semi")
    texts = _texts(docs, rows.drop("sig"), wanted.select("node").distinct(), id_col, text_col)
    # A node's digest names one text up to equal sets; repeated ids can bring a node twice.
    texts = settle(texts.groupBy("node").agg(F.first("text").alias("text")), "near-texts")
    links = settle(_verified(stars, texts, percent), "near-first")
    roots = settle(connected_components(links), "near-roots")

    open_nodes = _apart(_with_roots(filled.select("bucket", "node"), roots, "node")).select("node", F.col("node_root").alias("root")).distinct()
    open_texts = texts.join(settle(open_nodes, "near-open").hint("merge"), "node")
    roots = _linked(shared_prefixes(open_texts, shingle_set, percent), roots, texts, percent)
    named = settle(_with_roots(nodes.select("node", "least"), roots, "node").select("node", "least", F.col("node_root").alias("top")), "near-named")
    names = named.groupBy("top").agg(F.min("least").alias("component_id"), F.count("*").alias("m"))
    grouped = named.join(names, "top").select("node", "component_id")
    out = rows.select("id", "n_shingles", "node").join(grouped, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: the smallest id of each component.  An id of which one
    row stays keeps all its rows; rows without an id stay."""
    found = near_duplicates(docs, id_col, text_col, **options).where(F.col(id_col).isNotNull())
    gone = found.groupBy(F.col(id_col).alias("__gone")).agg(F.max("kept").alias("k")).where("NOT k").select("__gone")
    return docs.join(settle(gone, "near-gone").hint("merge"), F.col(id_col) == F.col("__gone"), "left_anti")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(greatest(len(words) - 4, 1)),
                                                lambda i: array_to_string(words[i + 1 : i + 5], ' '))) AS g
  FROM w WHERE len(words) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
least AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(l.component_id, w.doc_id) AS component_id,
       w.doc_id = coalesce(l.component_id, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least l ON l.a = w.doc_id
"""


@query("op8_minhash_dedup", SQL)
def op8_minhash_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
