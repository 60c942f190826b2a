"""Row numbers over whole tables, ranks in groups, and the first rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.storage import stored

_IN_PARTITION = (1 << 33) - 1


def numbered(df: DataFrame, to: str, *order: Column) -> DataFrame:
    """Numbers all rows from 1 in this order.

    A window without partitions would sort the whole table in one task. Here ranges of the order are sorted in parallel
    and written, which fixes their rows; a range's numbers start after the rows of the ranges before it, of which there is
    one count each.
    """
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(sorted_.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_range", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(_IN_PARTITION))
    counts = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_start"))
    # a row for each range, so no more than a shuffle has tasks; unless told, Spark shuffles all rows to meet them
    return placed.join(F.broadcast(starts), "_range").select((F.col("_start") + F.col("_at") + 1).alias(to), *(F.col(c) for c in df.columns))


def in_groups(df: DataFrame, to: str, keys: list[str], *order: Column) -> DataFrame:
    """Numbers the rows of each group from 1."""
    return df.withColumn(to, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))


def best_of(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each group in this order, by an aggregation that combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_best")).select(*keys, "_best.*")


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)
