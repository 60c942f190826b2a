"""Delimited strings taken apart and put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.config import UNKNOWN_COLUMN
from tracewell.functions.names import col


def explode_list(df: DataFrame, source: str | Column, to: str, delimiter: str = ",") -> DataFrame:
    """A row for each trimmed element; null has none, and an empty string one empty element."""
    return df.withColumn(to, F.explode(F.split(col(source), F.lit("\\Q" + delimiter + "\\E")))).withColumn(to, F.trim(to))


def explode_table_columns(df: DataFrame, details: str, table: str = "table_name", column: str = "column_name") -> DataFrame:
    """A row for each table and column of `T1:[c1,c2];T2:[c3]`; segments without a colon are left out."""
    parts = df.where(F.col(details).isNotNull()).withColumn("_segment", F.explode(F.split(details, ";")))
    # substring_index and replace work on bytes; split_part and translate took most of the time of large tables
    parts = parts.where(F.contains("_segment", F.lit(":")))
    parts = parts.withColumn(table, F.trim(F.substring_index("_segment", ":", 1)))
    listed = F.substring_index(F.substring_index("_segment", ":", 2), ":", -1)
    for bracket in "[]":
        listed = F.replace(listed, F.lit(bracket), F.lit(""))
    return parts.withColumn(column, F.explode(F.split(listed, ","))).withColumn(column, F.trim(column)).drop("_segment")


def table_columns_text(df: DataFrame, keys: list[str], table: str, column: str, to: str = "table_column_details") -> DataFrame:
    """The inverse: tables and columns sorted; a table without columns has the marker for unknown ones. Names have no NUL.

    Rows are grouped and shuffled once, by the keys. Each table and column is one string, `T1:[` NUL `c1`, since strings
    sort far faster than structs; sorted, a table's columns follow each other, and before them a lone `T1:[` where a
    column is null.
    """
    head = F.concat(F.col(table), F.lit(":["))
    pair = F.coalesce(F.concat(head, F.lit("\0"), F.col(column)), head)
    head_of = lambda c: F.substring_index(c, "\0", 1)
    alone = lambda c: ~F.contains(c, F.lit("\0"))

    def text(c: Column, i: Column) -> Column:
        before, after = F.get("_pairs", i - 1), F.get("_pairs", i + 1)
        follows = F.coalesce(head_of(before) == head_of(c), F.lit(False))
        unknown = F.when(head_of(after) == head_of(c), "").otherwise(UNKNOWN_COLUMN)
        name = F.when(alone(c), unknown).otherwise(F.substr(c, F.length(head_of(c)) + 2))
        return F.concat(F.when(~follows, F.concat(F.lit("];"), head_of(c))).when(alone(before), "").otherwise(","), name)

    pairs = df.groupBy(*keys).agg(F.sort_array(F.collect_set(pair)).alias("_pairs"))
    joined = F.concat(F.substr(F.array_join(F.transform("_pairs", text), ""), F.lit(3)), F.lit("]"))
    return pairs.select(*keys, F.when(F.size("_pairs") == 0, "").otherwise(joined).alias(to))


def without_alias(c: str | Column) -> Column:
    """`TABLE AS alias` less its alias."""
    return F.trim(F.regexp_replace(F.trim(col(c)), r"(?i)\s+AS\s+\w+\s*$", ""))
