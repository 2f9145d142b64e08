"""Session helpers.

The library never creates its own cluster settings: it reads what the
session already has.  ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "prepspark") -> SparkSession:
    """A local session configured the way tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PREPSPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster it must name a shared folder.  Only a session that runs on this machine alone (``local[n]``,
    as in tests) and has none gets a fresh temp folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = "file://" + tempfile.mkdtemp(prefix="prepspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    try:
        spark.sparkContext.setCheckpointDir(current)
    except Exception:  # noqa: BLE001 - remote (Connect) sessions read spark.checkpoint.dir themselves
        pass
    return current


def cut_lineage(df):
    """Reliable checkpoint: survives executor loss, truncates long plans."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str, *partition_by: str, compression: str | None = None):
    """``df`` written as a table in the checkpoint folder and read back; folders by ``partition_by`` can be pruned."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries made within leave no shuffle files: they go when the query ends, not when the driver collects garbage.

    Only for frames that are read once; for a frame that is read again they are made anew.
    """
    names = [f"spark.sql.{kind}.shuffleDependency.fileCleanup.enabled" for kind in ("classic", "connect")]
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "true")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
