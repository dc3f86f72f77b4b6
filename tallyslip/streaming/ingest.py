"""Incremental ingest: only files that no earlier run has seen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyslip.operators.batch import IMAGE_SUFFIXES


def incremental_ingest(spark: SparkSession, path: str, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Hand new images to `handle` and end. The source tracks paths; changed files are split_committed's business."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").load(path)
    images = files.filter(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(IMAGE_SUFFIXES))
    images.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(handle).start().awaitTermination()
