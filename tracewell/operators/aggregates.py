"""Aggregations of the relations and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.storage import spread


def list_distinct(c: str | Column, delimiter: str = ",") -> Column:
    """Distinct non-null values in order, joined."""
    return F.array_join(F.array_sort(F.collect_set(c)), delimiter)


def consolidate(relations: DataFrame, keys: list[str], tokens: str) -> DataFrame:
    """One row for each key with the union of its token lists."""
    one = relations.select(*keys, F.explode_outer(F.split(tokens, ",")).alias("_token")).distinct()
    return one.groupBy(*keys).agg(list_distinct("_token").alias(tokens))


def value_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows for each non-null value, the most frequent first."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key)


def token_counts(df: DataFrame, lists: str) -> DataFrame:
    """How often each token occurs in delimited lists."""
    tokens = df.select(F.explode(F.split(lists, ",")).alias("token")).select(F.trim("token").alias("token")).where("token != ''")
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def share(condition: Column) -> Column:
    """The share of rows for which it holds, 0 if there are none."""
    return F.coalesce(F.avg(F.when(condition, 1.0).otherwise(0.0)), F.lit(0.0))


def percentages(df: DataFrame, **conditions: Column) -> DataFrame:
    """The number of rows, and for each condition the rows that meet it and their percentage (0 if there are no rows)."""
    return df.agg(F.count("*").alias("total"), *(e for name, c in conditions.items() for e in (F.count_if(c).alias(name), F.round(100 * share(c), 1).alias(f"{name}_percent"))))


def column_count(simple: str | Column, nested: str | Column) -> Column:
    """Columns in a comma list and in `parent.child` lists together."""
    count = lambda c: F.size(F.filter(F.split(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), ","), lambda x: F.trim(x) != ""))
    return count(simple) + count(nested)


def unmapped(df: DataFrame, key: str, mapped: str) -> DataFrame:
    """Distinct keys without a mapping, and their rows."""
    return df.where(F.col(mapped).isNull()).groupBy(key).agg(F.count("*").alias("n"))


def majority_source(missing: DataFrame, definitions: DataFrame, keys: list[str], column: str, source: str, order: str) -> DataFrame:
    """For each key the first source that defines more than half of the missing columns."""
    wanted = missing.groupBy(*keys).agg(F.countDistinct(column).alias("_wanted"))
    has = missing.join(spread(definitions), [*keys, column]).groupBy(*keys, source, order).agg(F.countDistinct(column).alias("_has"))
    enough = has.join(spread(wanted), keys).where(2 * F.col("_has") > F.col("_wanted"))
    return enough.groupBy(*keys).agg(F.min_by(source, order).alias(source))
