"""Writers."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tracewell.storage import stored

MAPPING_COLUMNS = (
    "frontend_file", "frontend_function", "http_method", "frontend_url", "backend_file", "backend_function", "backend_route", "database_tables",
    "stored_procedures", "flow_calls", "response_model", "response_fields", "nested_fields", "table_column_details",
)


def write_csv(df: DataFrame, path: str, mode: str = "error", files: int | None = None) -> None:
    """CSV with a header, an empty table too. `files` bounds the number of files, for small reports."""
    out = df if files is None else df.coalesce(files)
    out.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def append_run(df: DataFrame, path: str, run: str) -> None:
    """Adds a run's rows as a partition of their own, so that a failed run leaves the others as they are."""
    df.withColumn("run_ts", F.lit(run)).write.mode("append").partitionBy("run_ts").option("header", True).csv(path)


def append_or_back_up(df: DataFrame, path: str, backup: str) -> str:
    """Adds rows to a Parquet table and returns its path; where that fails, they go to backup, and the table is as before.

    Spark commits files only once all tasks are done, so a failed append leaves nothing in the table.
    """
    kept = stored(df, "append")  # computed once: a failure of df itself is the caller's
    try:
        kept.write.mode("append").parquet(path)
        return path
    except Exception:
        kept.write.mode("error").parquet(backup)
        return backup


def write_with_totals(df: DataFrame, path: str, **totals: Column) -> dict[str, object]:
    """Writes Parquet and returns aggregates of the rows, gathered while they are written: no second scan."""
    seen = Observation()
    df.observe(seen, *(c.alias(name) for name, c in totals.items())).write.mode("error").parquet(path)
    return seen.get


def run_totals(uses: DataFrame, path: str) -> dict[str, object]:
    """Writes relations of procedures and returns how many there are, of how many procedures and tables (approximately, as one pass allows), and relations a procedure."""
    found = write_with_totals(uses, path, n_relations=F.count("*"), n_procedures=F.approx_count_distinct("sp_name", 0.01), n_tables=F.approx_count_distinct("table_name", 0.01))
    return found | {"relations_a_procedure": found["n_relations"] / found["n_procedures"] if found["n_procedures"] else 0.0}


def write_names(names: DataFrame, path: str) -> None:
    """A text file list, a name a line, in order."""
    column = names.columns[0]
    names.where(F.col(column).isNotNull()).select(F.col(column).cast("string")).orderBy(column).write.mode("error").text(path)


def mapping_rows(mapping: DataFrame) -> DataFrame:
    """The fixed columns in order; what an unmatched call lacks is an empty string."""
    have = {c.lower() for c in mapping.columns}
    return mapping.select(*(F.coalesce(F.col(c) if c in have else F.lit(None), F.lit("")).alias(c) for c in MAPPING_COLUMNS))


def relationship_type(tables: str) -> Column:
    """How many tables a mapping has: none, one or several; unmatched without a back end."""
    n = F.size(F.filter(F.split(F.coalesce(F.col(tables), F.lit("")), "[;,]"), lambda t: F.trim(t) != ""))
    return F.when(F.coalesce(F.col("backend_function"), F.lit("")) == "", "unmatched").when(n == 0, "no_tables").when(n == 1, "single_table").when(n > 1, "multi_table_join").otherwise("unknown")


def as_json(df: DataFrame, to: str = "json") -> DataFrame:
    """Each row as JSON text."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(to))


def records(df: DataFrame, most: int) -> str:
    """The first rows as an indented JSON list; `most` bounds what comes to the driver."""
    return json.dumps([r.asDict(recursive=True) for r in df.limit(most).collect()], indent=2, default=str)


def save_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def save_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)
