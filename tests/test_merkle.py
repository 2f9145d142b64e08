import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from prepspark.operators import merkle as M


def plain_root(hashes, fan):
    level = sorted(hashes)
    while len(level) > 1:
        level = [hashlib.sha256("".join(level[i : i + fan]).encode()).hexdigest() for i in range(0, len(level), fan)]
    return level[0] if level else hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("fan", [3, 256])
def test_root_under_repartitioning_and_changes(spark, fan):
    df = spark.range(60).select((F.col("id") % 50).alias("a"), F.when(F.col("id") % 7 != 0, F.lit("x")).alias("b"))
    tree = M.merkle_tree(df, fan=fan)
    hashes = [r[0] for r in df.select(M.row_hash(df)).collect()]
    root = M.merkle_root(tree).first()
    assert tuple(root) == (60, plain_root(hashes, fan))
    again = df.orderBy(F.desc("a")).repartition(7)
    assert M.merkle_root(M.merkle_tree(again, fan=fan)).first() == root
    changed = df.withColumn("b", F.when(F.col("a") == 3, "y").otherwise(F.col("b")))
    assert M.merkle_root(M.merkle_tree(changed, fan=fan)).first()["root"] != root["root"]
    steps = M.proof(tree, hashes[11], fan).collect()
    assert M.proves(steps, hashes[11], root["root"]) and not M.proves(steps, hashes[12], root["root"])
    assert not M.proves(steps, hashes[11], hashes[11]) and M.proof(tree, "none", fan).count() == 0


def test_empty_and_single(spark):
    df = spark.range(1)
    assert M.merkle_root(M.merkle_tree(df)).first()["rows"] == 1
    assert tuple(M.merkle_root(M.merkle_tree(df.where("false"))).first()) == (0, hashlib.sha256(b"").hexdigest())


def test_hot_rows_and_many_partitions(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id")).alias("a")).repartition(5)
    hashes = [r[0] for r in df.select(M.row_hash(df)).collect()]
    tree = M.merkle_tree(df, fan=16)
    assert tuple(M.merkle_root(tree).first()) == (3000, plain_root(hashes, 16))
    levels = {r["level"]: (r["n"], r["last"]) for r in tree.groupBy("level").agg(F.count("*").alias("n"), F.max("place").alias("last")).collect()}
    assert levels == {0: (3000, 2999), 1: (188, 187), 2: (12, 11), 3: (1, 0)}
    leaves = [r["hash"] for r in tree.where("level = 0").orderBy("place").collect()]
    assert leaves == sorted(hashes)


def test_leaves_take_little_disk(spark):
    def held():
        tops = [spark.conf.get("spark.checkpoint.dir").removeprefix("file://")]
        tops += [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
        files = [os.path.join(d, f) for top in tops for d, _, names in os.walk(top) for f in names]
        return {f: os.path.getsize(f) for f in files if not f.endswith(".crc") and (".parquet" in f or "/shuffle_" in f)}

    before = held()
    assert M.merkle_root(M.merkle_tree(spark.range(100_000))).first()["rows"] == 100_000
    assert sum(size for f, size in held().items() if f not in before) < 50 * 100_000  # 32 bytes and a place; 134 before


def test_runs_end_at_gaps_and_nodes():
    assert [*M._runs(np.array([1, 2, 3, 4, 5, 9, 10, 3, 4]), 4)] == [(0, 3), (3, 5), (5, 7), (7, 8), (8, 9)]
    assert [*M._runs(np.array([7]), 4)] == [(0, 1)]
