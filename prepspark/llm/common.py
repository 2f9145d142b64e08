"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

#: The white space of the contracts: space and the control characters tab to carriage return.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` with its DuckDB SQL, where there is one."""

    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session has none (tests on one machine) a temporary one is set.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="prepspark-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage like a checkpoint (a lost executor re-reads files instead of
    repeating the stages before), and the files' size is known to the optimizer, so
    that joins with it are broadcast only below the session's threshold.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_FIXED: dict = {}
_HELD: dict = {}


def fixed(key, build: Callable):
    """What a Python worker keeps between tasks: a table whose size is a model's, not the data's."""
    if key not in _FIXED:
        if len(_FIXED) >= 2:
            _FIXED.clear()
        _FIXED[key] = build()
    return _FIXED[key]


def held(key, build: Callable):
    """What a Python worker keeps while a task runs (a model, a cache of words)."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]


def releasing(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``; what its worker held goes when the task ends, since idle workers of an
    executor stay and their memory would add up."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            _HELD.clear()

    return task


def slices(batches, rows: int = 256):
    """Arrow batches in parts of few rows: only a part's texts are Python objects at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often it is used."""
    return F.transform(F.array(value), body)[0]
