"""The folder that driver and executors share, and tables in it that cut a plan's lineage."""

from __future__ import annotations

import atexit
import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where that is unset and driver and executors are one process, as in tests."""
    place = spark.conf.get("spark.checkpoint.dir", None) or _OWN.get("dir")
    if not place:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = _OWN["dir"] = "file://" + tempfile.mkdtemp(prefix="tracewell-")
    return place.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may have ended before
        pass


def dealt(df: DataFrame) -> DataFrame:
    """df's rows dealt evenly over as many tasks as a shuffle has, for work on each row that costs far more than reading it: a small file is one task, however long its rows take."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame) -> DataFrame:
    """df, to be joined by sorting both sides and never broadcast: for tables that grow with the input. Spark takes a table for as small as its compressed files, so one of 10 MB there may be some hundred in the driver and each executor."""
    return df.hint("merge")


def stored(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """df written to the shared folder and read again: this cuts the lineage and survives lost executors.

    Spark deletes a shuffle's files once the driver's JVM has collected what refers to it. release asks for that now:
    for writes behind large shuffles, whose files would lie beside those of the next step.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tracewell/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    if release:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)
