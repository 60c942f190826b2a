"""An addition: files that arrive are searched for names as they come."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tracewell.operators.joins import word_references


def arriving_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files of a folder as a stream: path and content."""
    return spark.readStream.format("text").option("wholetext", "true").load(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def search_arriving(spark: SparkSession, path: str, names: DataFrame, name: str, out: str, checkpoint: str) -> StreamingQuery:
    """Appends (path, name) for each arriving file to Parquet; `names` is static and read anew for each batch."""
    found = word_references(arriving_texts(spark, path), names, "content", name).select("path", name)
    return found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Runs a batch function on what has arrived, for sinks that replace rows by key."""
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
