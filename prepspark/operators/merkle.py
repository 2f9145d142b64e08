"""AU1: a table's content hash as the root of a Merkle tree, with proofs of single rows.

A leaf is the SHA-256 of a row's text; leaves are sorted by hash, so that the root does not depend on the
order or the partitions of the rows, and repeated rows count.  A node is the SHA-256 of the joined
hashes of up to ``FAN`` children, and there are log(rows) / log(FAN) levels.  Leaves are shuffled once, as 32
bytes, into sorted range partitions and stored; their place is that in the partition and the rows of those
before.  Stored leaves are read in runs, so a task makes the nodes above its runs itself and only the pieces
of nodes at the ends of runs meet in a shuffle.  Levels above are one aggregate of at most ``FAN`` hashes a
group.  A changed, added or missing row changes the root; ``proof`` names the hashes that lead from one row
to it, and anybody can recompute them.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import brief_shuffles, stored
from .audit import row_string

FAN = 256
#: Leaves that a task sorts.
TASK_LEAVES = 1_000_000
# Bits of a row's number within its partition in Spark's monotonically_increasing_id.
ROW_BITS = 33


def row_hash(df: DataFrame, columns: list[str] | None = None):
    return F.sha2(row_string(df, columns), 256)


def _leaves(df: DataFrame, columns: list[str] | None) -> DataFrame:
    """(``id``, ``hash``): the rows' hashes as bytes, stored in their order, which is that of ``id``."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / TASK_LEAVES))
    copy = (F.monotonically_increasing_id() % 256).cast("short")  # parts the copies of a hot row
    leaves = df.select(F.unhex(row_hash(df, columns)).alias("hash"), copy.alias("copy"))
    placed = leaves.repartitionByRange(parts, "hash", "copy").sortWithinPartitions("hash")
    with brief_shuffles(df.sparkSession):
        return stored(placed.select(F.monotonically_increasing_id().alias("id"), "hash"), "merkle", compression="zstd")


def _runs(place: np.ndarray, fan: int) -> Iterator[tuple[int, int]]:
    """(from, to) of the stretches of ``place`` that count up by one below one node."""
    ends = np.flatnonzero((np.diff(place) != 1) | (place[1:] % fan == 0)) + 1
    return zip([0, *ends.tolist()], [*ends.tolist(), len(place)])


def _parents(leaves: DataFrame, offsets: list[int], rows: int, fan: int) -> DataFrame:
    """(``level``, ``place``, ``hash``) of the nodes right above stored ``leaves``."""
    starts = np.array(offsets, np.int64)

    def run(batches):
        node, at, held = -1, 0, b""  # an open piece: its node, the place of its first leaf, its hashes

        def made():
            if len(held) // 32 == min(fan, rows - node * fan):
                return node, None, hashlib.sha256(held.hex().encode()).hexdigest()
            return node, at, held.hex()

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            place = starts[ids >> ROW_BITS] + (ids & (1 << ROW_BITS) - 1)
            whole, found = b"".join(batch.column(1).to_pylist()), []
            for a, b in _runs(place, fan):
                if place[a] // fan != node or place[a] != at + len(held) // 32:
                    if held:
                        found.append(made())
                    node, at, held = int(place[a]) // fan, int(place[a]), b""
                held += whole[32 * a : 32 * b]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*found), types)], names)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(made(), types)], names)

    types, names = (pa.int64(), pa.int64(), pa.string()), ["place", "first", "text"]
    pieces = leaves.mapInArrow(run, "place bigint, first bigint, text string")
    pieces = stored(pieces, "merkle")
    ends = pieces.where("first IS NOT NULL").groupBy("place").agg(F.array_sort(F.collect_list(F.struct("first", "text"))).alias("c"))
    whole = pieces.where("first IS NULL").select("place", F.col("text").alias("hash"))
    both = whole.unionByName(ends.select("place", F.sha2(F.array_join("c.text", ""), 256).alias("hash")))
    return both.select(F.lit(1).alias("level"), "place", "hash")


def merkle_tree(df: DataFrame, columns: list[str] | None = None, fan: int = FAN) -> DataFrame:
    """(``level``, ``place``, ``hash``): leaves at level 0, each level's places from 0, the root alone at the last."""
    leaves = _leaves(df, columns)
    part, row = F.shiftright("id", ROW_BITS), F.col("id").bitwiseAND((1 << ROW_BITS) - 1)
    sizes = {r["part"]: r["n"] for r in leaves.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [sizes.get(i, 0) for i in range(max(sizes, default=-1) + 1)]
    *offsets, n = itertools.accumulate(counts, initial=0)
    place = F.get(F.array(*[F.lit(o).cast("long") for o in offsets or [0]]), part.cast("int")) + row
    tree = leaves.select(F.lit(0).alias("level"), place.alias("place"), F.lower(F.hex("hash")).alias("hash"))
    level = None
    while n > 1:
        if level is None:
            level = stored(_parents(leaves, offsets, n, fan), "merkle")
        else:
            parent = F.floor(F.col("place") / fan).cast("long")
            children = F.array_sort(F.collect_list(F.struct("place", "hash")))
            joined = level.groupBy((F.col("level") + 1).alias("level"), parent.alias("place")).agg(children.alias("c"))
            level = stored(joined.select("level", "place", F.sha2(F.array_join("c.hash", ""), 256).alias("hash")), "merkle")
        tree, n = tree.unionByName(level), -(-n // fan)
    return tree


def merkle_root(tree: DataFrame) -> DataFrame:
    """(``rows``, ``root``): number of leaves, and the root; the hash of nothing for an empty table."""
    top = F.max_by("hash", F.col("level")).alias("root")
    out = tree.agg(F.coalesce(F.sum((F.col("level") == 0).cast("bigint")), F.lit(0)).alias("rows"), top)
    return out.select("rows", F.coalesce("root", F.lit(hashlib.sha256(b"").hexdigest())).alias("root"))


def proof(tree: DataFrame, leaf: str, fan: int = FAN) -> DataFrame:
    """(``level``, ``before``, ``hash``, ``after``): per level the node on the way of one leaf and what is joined around it."""
    rows = tree.where((F.col("level") == 0) & (F.col("hash") == leaf)).agg(F.min("place").alias("at")).first()
    if rows["at"] is None:
        return tree.sparkSession.createDataFrame([], "level int, before string, hash string, after string")
    at = F.floor(F.lit(rows["at"]) / F.pow(F.lit(float(fan)), F.col("level"))).cast("long")
    near = tree.withColumn("at", at).where(F.floor(F.col("place") / fan) == F.floor(F.col("at") / fan))

    def side(test):
        return F.array_join(F.array_sort(F.collect_list(F.when(test, F.struct("place", "hash"))))["hash"], "")

    own = F.max(F.when(F.col("place") == F.col("at"), F.col("hash")))
    return near.groupBy("level").agg(
        side(F.col("place") < F.col("at")).alias("before"), own.alias("hash"), side(F.col("place") > F.col("at")).alias("after"))


def proves(steps: list, leaf: str, root: str) -> bool:
    """Whether the rows of ``proof`` lead from ``leaf`` to ``root``."""
    now = leaf
    ordered = sorted(steps, key=lambda r: r["level"])
    for k, row in enumerate(ordered):
        if row["hash"] != now:
            return False
        if k < len(ordered) - 1:
            now = hashlib.sha256((row["before"] + row["hash"] + row["after"]).encode()).hexdigest()
    return bool(ordered) and now == root
