"""Applying fitted plans to a stream (extension X1; not part of the reference).

Every transform in the library is a row-wise ``select`` over literals fitted
in batch, so a fitted plan applies unchanged to ``spark.readStream``.  The
only stateful step, de-duplication, becomes
``withWatermark(...).dropDuplicatesWithinWatermark(...)`` so its state stays
bounded by the watermark delay.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def file_stream(spark: SparkSession, directory: str, file_glob: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(fmt).load(directory)


def apply_plans(sdf: DataFrame, *plans) -> DataFrame:
    out = sdf
    for p in plans:
        out = p.transform(out)
    return out


def dedupe_stream(sdf: DataFrame, columns: list[str], event_time: str, delay: str = "1 hour") -> DataFrame:
    return sdf.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(columns)


def run_available(sdf: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Process everything available now into ``out_path`` and stop (exactly-once file sink)."""
    q = (sdf.writeStream.format(fmt).option("path", out_path).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def stream_output_paths(root: str, name: str) -> tuple[str, str]:
    return os.path.join(root, "streams", name, "out"), os.path.join(root, "streams", name, "_checkpoint")
