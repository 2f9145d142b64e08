"""Exact similarity join of sets by their rarest members (prefix filter with positions).

Two sets with a Jaccard similarity of p % or more share at least ``p / (100 + p)`` of the sum of
their sizes.  In any fixed order of members, the first common member of such a pair then stands
early in both sets.  With rare members first, sets meet only in members that few sets hold, and a
passage that thousands of texts share stands last and brings nobody together.

1. Sets are 32-bit hashes, packed into rows of ``BATCH`` sets (``batched_sets``).
2. Every row sends its distinct members, cut by hash into ``bucket``s of bounded size, to be counted
   over all rows, and gets the counts back, one byte a member (``rarities``).  A member that a
   third of all sets holds sends one entry a row.
3. Each set is ordered by (count, hash); the entries of its prefix that other sets hold too become
   rows (``prefixes``).  A set most of whose members nobody else holds has no row.
4. Rows meet by member if the positions still admit the similarity and the components differ.  The
   component that holds most rows of a member never meets itself, and meets others by its first
   nodes before it meets them by all (``candidates``).

Every step is exact up to hashes that coincide, which only add candidates: what a set loses by
coinciding hashes is taken off what it must share.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import releasing, settle, slices

BATCH = 256
#: Members whose counts a task holds at a time.
BUCKET_MEMBERS = 2_000_000
MOST = 255


def batched_sets(texts: DataFrame, sets_of: Callable) -> DataFrame:
    """Rows of ``BATCH`` sets from (node, root, text): ``batch``, ``nodes``, ``roots``, ``sizes``, ``sets`` (sorted u32)."""

    def run(batches):
        part, made = TaskContext.get().partitionId(), 0
        for batch in slices(batches, BATCH):
            if not batch.num_rows:
                continue
            found = [sets_of(t.as_py()) for t in batch.column(2)]
            small = [np.unique((s >> np.uint64(32)).astype("<u4")) for s in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + made], pa.int64()), pa.array([batch.column(0).to_pylist()], pa.list_(pa.binary())),
                    pa.array([batch.column(1).to_pylist()], pa.list_(pa.binary())), pa.array([[len(s) for s in found]], pa.list_(pa.int32())),
                    pa.array([[len(s) for s in small]], pa.list_(pa.int32())), pa.array([b"".join(s.tobytes() for s in small)], pa.binary()),
                ],
                ["batch", "nodes", "roots", "sizes", "held", "sets"],
            )
            made += 1

    schema = "batch bigint, nodes array<binary>, roots array<binary>, sizes array<int>, held array<int>, sets binary"
    return settle(texts.select("node", "root", "text").mapInArrow(releasing(run), schema), "sets")


def _spread(members: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order by bucket and hash, bucket ends) of sorted distinct members."""
    bucket = members % np.uint32(buckets)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def rarities(sets: DataFrame, buckets: int) -> DataFrame:
    """(``batch``, ``bucket``, ``counts``): in how many sets each distinct member of a row occurs, ``MOST`` at most."""

    def send(batches):
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                members, n = np.unique(np.frombuffer(blob.as_buffer(), "<u4"), return_counts=True)
                order, ends = _spread(members, buckets)
                members, n = members[order], np.minimum(n, MOST)[order].astype(np.uint8)
                parts = [b for b in range(buckets) if ends[b] < ends[b + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(parts, pa.int32()), pa.array([number] * len(parts), pa.int64()),
                        pa.array([members[ends[b] : ends[b + 1]].tobytes() for b in parts], pa.binary()),
                        pa.array([n[ends[b] : ends[b + 1]].tobytes() for b in parts], pa.binary()),
                    ],
                    ["bucket", "batch", "members", "n"],
                )

    def answer(bucket: int, rows: list):
        values = np.concatenate([np.frombuffer(m, "<u4") for _, m, _ in rows])
        counts = np.concatenate([np.frombuffer(n, np.uint8) for _, _, n in rows])
        order = np.argsort(values, kind="stable")
        first = np.flatnonzero(np.diff(values[order], prepend=~values[order[:1]]))
        total = np.minimum(np.add.reduceat(counts[order].astype(np.int64), first), MOST).astype(np.uint8)
        back = np.empty(len(values), np.uint8)
        back[order] = np.repeat(total, np.diff(first, append=len(values)))
        ends = np.cumsum([len(n) for _, _, n in rows])
        blobs = [back[e - len(n) : e].tobytes() for e, (_, _, n) in zip(ends, rows)]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([bucket] * len(rows), pa.int32()), pa.array(blobs, pa.binary())],
            ["batch", "bucket", "counts"],
        )

    def count(batches):
        at, rows = None, []
        for batch in batches:
            for bucket, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if bucket != at and rows:
                    yield answer(at, rows)
                    rows = []
                at = bucket
                rows.append(row)
        if rows:
            yield answer(at, rows)

    sent = sets.select("batch", "sets").mapInArrow(send, "bucket int, batch bigint, members binary, n binary")
    met = sent.repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(count, "batch bigint, bucket int, counts binary")


def prefixes(sets: DataFrame, counts: DataFrame, buckets: int, percent: int) -> DataFrame:
    """(``member``, ``node``, ``root``, ``size``, ``rest``): prefix entries that other sets hold too.

    ``rest`` is how many members a set can still share from this one on.
    """

    def entries(row, found: list[bytes]):
        nodes, roots, sizes, held, blob = row
        every = np.frombuffer(blob, "<u4")
        members = np.unique(every)
        order, _ = _spread(members, buckets)
        often = np.empty(len(members), np.uint8)
        often[order] = np.frombuffer(b"".join(found), np.uint8)
        out, end = [], 0
        for i, (size, n) in enumerate(zip(sizes, held)):
            own = every[end : end + n]
            end += n
            least = -(-percent * size // 100) - (size - n)
            n_own = often[np.searchsorted(members, own)]
            if (n_own > 1).sum() < least:
                continue
            ranked = np.lexsort((own, n_own))[: n - least + 1]
            places = np.flatnonzero(n_own[ranked] > 1)
            out.append((i, own[ranked[places]], size - places))
        which = np.repeat([i for i, _, _ in out], [len(m) for _, m, _ in out]).astype(int).tolist()
        cat = lambda k, t: np.concatenate([o[k] for o in out] or [np.empty(0)]).astype(t)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(cat(1, np.int64)), pa.array([nodes[i] for i in which], pa.binary()), pa.array([roots[i] for i in which], pa.binary()),
                pa.array([sizes[i] for i in which], pa.int32()), pa.array(cat(2, np.int32)),
            ],
            ["member", "node", "root", "size", "rest"],
        )

    def run(batches):
        row, found = None, []
        for batch in batches:
            for bucket, counted, *own in zip(*[c.to_pylist() for c in batch.columns]):
                if bucket >= 0:
                    found.append(counted)
                    continue
                if row:
                    yield entries(row, found)
                row, found = own, []
        if row:
            yield entries(row, found)

    both = sets.withColumn("bucket", F.lit(-1)).unionByName(counts, allowMissingColumns=True)
    both = both.repartition("batch").sortWithinPartitions("batch", "bucket")
    both = both.select("bucket", "counts", "nodes", "roots", "sizes", "held", "sets")
    return both.mapInArrow(run, "member bigint, node binary, root binary, size int, rest int")


def shared_prefixes(texts: DataFrame, sets_of: Callable, percent: int) -> DataFrame:
    """The stored ``prefixes`` of (node, root, text), without their roots, which change."""
    sets = batched_sets(texts, sets_of)
    total = sets.agg(F.sum(F.aggregate("held", F.lit(0).cast("bigint"), lambda t, x: t + x))).first()[0] or 0
    buckets = 1 + total // BUCKET_MEMBERS
    return settle(prefixes(sets, rarities(sets, buckets), buckets, percent).drop("root"), "prefixes")


def mixed_members(rows: DataFrame) -> DataFrame:
    """``rows`` (member, node, root, size, rest) of members that several components hold, with ``top`` (the component
    with most rows) and ``place``: within member and component, the node that can share most members first."""
    shares = rows.groupBy("member", "root").agg(F.count("*").alias("n"))
    mixed = shares.groupBy("member").agg(F.max_by("root", F.struct("n", "root")).alias("top"), F.count("*").alias("roots"))
    mixed = settle(mixed.where("roots > 1").select("member", "top"), "members")
    order = Window.partitionBy("member", "root").orderBy(F.desc("rest"), "node")
    return settle(rows.join(mixed.hint("merge"), "member").withColumn("place", F.row_number().over(order)), "shared")


def candidates(shared: DataFrame, percent: int, upto: int) -> DataFrame:
    """(``a``, ``b``): pairs of ``mixed_members`` of different components whose sets can be ``percent`` similar.

    Every node outside a member's top component meets the first ``upto`` nodes of each other component.
    """
    left = shared.where("root <> top").select(
        "member", F.col("node").alias("a"), F.col("root").alias("a_root"), F.col("size").alias("a_size"), F.col("rest").alias("a_rest")
    )
    admitted = (100 + percent) * F.least("rest", "a_rest") >= percent * (F.col("size") + F.col("a_size"))
    met = shared.where(F.col("place") <= upto).join(left.hint("merge"), "member").where((F.col("root") != F.col("a_root")) & admitted)
    return met.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
