"""The enrichment relations: analyzers' output joined to the catalog. Each is a function of DataFrames.

Names of columns are those of tracewell.schemas. `numbered` ids have all columns of the relation as tie-breakers, nulls
last, so that they are the same on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.predicates import procedure_name
from tracewell.operators.aggregates import list_distinct
from tracewell.operators.delimited import explode_list, explode_table_columns, without_alias
from tracewell.operators.joins import suffix_join, wildcard_column_join
from tracewell.operators.ranking import numbered
from tracewell.storage import dealt, stored

ACTION_COLUMNS = ["frontend_file", "frontend_function", "http_method", "frontend_url", "backend_file", "backend_function", "backend_route", "response_model"]


def _in_order(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def _same(a: Column, b: Column) -> Column:
    return F.upper(a) == F.upper(b)


def _numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows with ids in this order. They are stored before, since the sample that finds the ranges of the order would take them apart and join them once more."""
    return numbered(stored(rows, "rows"), "id", *order)


def action_table_columns(actions: DataFrame, base_names: DataFrame, base_table: DataFrame, keep: list[str] = ACTION_COLUMNS) -> DataFrame:
    """Actions by table and column, with the keys of both."""
    rows = explode_table_columns(actions, "table_column_details").select(*keep, "table_name", "column_name")
    names = base_names.select(F.col("base_primary_id").alias("table_key"), F.col("table_name").alias("_base"))
    columns = base_table.select(F.col("primary_key").alias("column_key"), F.col("table_name").alias("_table"), F.col("column_names").alias("_column"))
    found = rows.join(names, _same(rows["table_name"], names["_base"]), "left")
    found = found.join(columns, _same(found["table_name"], columns["_table"]) & _same(found["column_name"], columns["_column"]), "left")
    return _numbered(found.select(*keep, "table_name", "column_name", "table_key", "column_key"), *_in_order(*keep[:2], "table_name", "column_name", *keep[2:], "table_key", "column_key"))


def action_columns(actions: DataFrame, base_table: DataFrame, keep: list[str] = ACTION_COLUMNS) -> DataFrame:
    """The variant with the column catalog alone."""
    rows = explode_table_columns(actions, "table_column_details").select(*keep, "table_name", "column_name")
    columns = base_table.select("primary_key", "base_primary_id", "schema_name", F.col("table_name").alias("_table"), F.col("column_names").alias("_column"))
    found = rows.join(columns, _same(rows["table_name"], columns["_table"]) & _same(rows["column_name"], columns["_column"]), "left")
    return _numbered(found.select(*keep, "table_name", "column_name", "primary_key", "base_primary_id", "schema_name"), *_in_order(*keep[:2], "table_name", "column_name", *keep[2:], "primary_key"))


def action_tables(actions: DataFrame, base_names: DataFrame | None = None, keep: list[str] = ACTION_COLUMNS, delimiter: str = ",") -> DataFrame:
    """Actions by table; with base_names, also the table's key."""
    rows = explode_list(actions.where(F.col("database_tables").isNotNull()), "database_tables", "table_name", delimiter).select(*keep, "table_name")
    if base_names is None:
        return _numbered(rows, *_in_order(*keep[:2], "table_name", *keep[2:]))
    names = base_names.select(F.col("base_primary_id").alias("table_key"), F.col("table_name").alias("_base"))
    found = rows.join(names, _same(rows["table_name"], names["_base"]), "left").drop("_base")
    return _numbered(found, *_in_order(*keep[:2], "table_name", *keep[2:], "table_key"))


def lineage_with_keys(lineage: DataFrame, base_table: DataFrame, view_table: DataFrame) -> DataFrame:
    """View columns by source table, with the keys of the source column and of the view column.

    source_column is compared as it stands, so a list of several columns has no table_key; lineage_pairs() has them singly.
    """
    rows = explode_list(lineage, "source_table", "_source", ";").withColumn("source_table_full", without_alias("_source"))
    rows = rows.withColumn("_parts", F.split("source_table_full", r"\."))
    rows = rows.select("view_name", "view_column", F.element_at("_parts", -1).alias("source_table"), "source_column", F.when(F.size("_parts") > 1, F.element_at("_parts", -2)).alias("base_schema"), "source_table_full")
    base = base_table.select(F.col("primary_key").alias("table_key"), F.col("table_name").alias("_table"), F.col("column_names").alias("_column"))
    views = view_table.select(F.col("primary_key").alias("view_key"), F.col("view_name").alias("_view"), F.col("column_names").alias("_view_column"))
    found = rows.join(base, _same(rows["source_table"], base["_table"]) & _same(rows["source_column"], base["_column"]), "left")
    found = found.join(views, _same(found["view_name"], views["_view"]) & _same(found["view_column"], views["_view_column"]), "left")
    return found.select("view_name", "view_column", "source_table", "source_column", "table_key", "view_key", "base_schema", "source_table_full")


def dashboards_with_keys(dashboards: DataFrame, base_names: DataFrame, view_names: DataFrame) -> DataFrame:
    """Dashboard tables with the keys of tables or views; names are compared as written."""
    base = base_names.select("base_primary_id", F.col("table_name").alias("_base"))
    views = view_names.select("view_primary_id", F.col("view_name").alias("_view"))
    d = dashboards
    qualified = d["schema_name"].isNotNull() & (base["_base"] == F.concat(d["schema_name"], F.lit("."), d["table_name"]))
    last = F.split_part(base["_base"], F.lit("."), F.lit(-1))
    # whichever of the three holds, the last parts agree, which is the key of the join
    same = (last == F.split_part(d["table_name"], F.lit("."), F.lit(-1))) & ((last == d["table_name"]) | (base["_base"] == d["table_name"]) | qualified)
    found = d.join(base, same & (d["type"] == "BASE TABLE"), "left")
    found = found.join(views, (found["table_name"] == views["_view"]) & (found["type"] == "VIEW"), "left")
    return found.select("table_name", "liveboard_name", "guid", "schema_name", "type", "base_primary_id", "view_primary_id")


def procedure_columns(procedures: DataFrame, base_names: DataFrame, base_table: DataFrame) -> DataFrame:
    """Columns that procedures use, with the keys of table and column; rows that match no table are left out."""
    names = base_names.select("base_primary_id", F.col("table_name").alias("_base"))
    columns = base_table.select("primary_key", F.col("base_primary_id").alias("_id"), F.col("column_names").alias("_column"))
    found = suffix_join(procedures, names, "table_name", "_base").where("base_primary_id is not null")
    found = found.join(columns, (found["base_primary_id"] == columns["_id"]) & _same(found["column_name"], columns["_column"]), "left")
    rows = found.select("sp_name", "sp_schema", "table_name", "column_name", "relationship_types", F.col("base_primary_id").alias("base_table_id"), F.col("primary_key").alias("base_column_id"))
    return _numbered(rows, *_in_order("sp_name", "table_name", "column_name", "sp_schema", "relationship_types", "base_table_id", "base_column_id"))


def procedure_routes(actions: DataFrame, any_case: bool = False, prefix: str = "") -> DataFrame:
    """Routes that call a procedure, as a list, by its upper-case name without the prefix that names of procedures have in code."""
    rows = explode_list(actions.where(F.col("stored_procedures").isNotNull()), "stored_procedures", "_sp").where(procedure_name("_sp"))
    has = F.startswith(F.upper("_sp"), F.upper(F.lit(prefix))) if any_case else F.startswith("_sp", F.lit(prefix))
    name = F.upper(F.when(has, F.substr("_sp", F.lit(len(prefix) + 1))).otherwise(F.col("_sp")))
    return rows.groupBy(name.alias("sp_found")).agg(list_distinct("backend_route").alias("backend_routes"))


def procedure_triggers(procedure_columns_: DataFrame, flows: DataFrame, actions: DataFrame, prefix: str = "") -> DataFrame:
    """Procedure columns with what triggers the procedure: flows, endpoints, both or neither. Flows are grouped by the name as written."""
    p = procedure_columns_
    repos = flows.groupBy(F.col("sp_name").alias("_flow")).agg(list_distinct("repo_name").alias("repo_names"))
    routes = procedure_routes(actions, prefix=prefix)
    found = p.join(repos, _same(p["sp_name"], repos["_flow"]), "left").join(routes, F.upper(p["sp_name"]) == routes["sp_found"], "left")
    by_flow, by_api = F.col("_flow").isNotNull(), F.col("sp_found").isNotNull()
    trigger = F.when(by_flow & by_api, "flow_triggered,api_triggered").when(by_flow, "flow_triggered").when(by_api, "api_triggered").otherwise("")
    rows = found.select("sp_name", "sp_schema", "table_name", "column_name", "relationship_types", "base_table_id", "base_column_id", trigger.alias("trigger_type"), F.when(by_flow, F.col("repo_names")).when(by_api, F.col("backend_routes")).alias("source_reference"))
    return _numbered(rows, *_in_order("sp_name", "table_name", "column_name", "sp_schema", "relationship_types", "base_table_id", "base_column_id", "source_reference"))


def repo_references(references: DataFrame, base_table: DataFrame, view_table: DataFrame) -> DataFrame:
    """References in repositories with the keys of tables' and views' columns; one without a column stands for all."""
    base = base_table.select(F.col("primary_key").alias("base_key"), F.col("base_primary_id"), F.col("table_name").alias("_table"), F.col("column_names").alias("base_column"))
    views = view_table.select(F.col("primary_key").alias("view_key"), F.col("view_name").alias("_view"), F.col("column_names").alias("view_column"))
    # one reference may stand for all columns, so few rows read become many: they are dealt before, not by tables' names alone
    found = wildcard_column_join(dealt(references), base, "table_name", "column_name", "_table", "base_column")
    found = wildcard_column_join(found, views, "table_name", "column_name", "_view", "view_column")
    return found.select("repo_name", "function_name", "table_name", "column_name", "file_name", "base_key", "base_primary_id", "base_column", "view_key", "view_column")


def lineage_pairs(edges: DataFrame) -> DataFrame:
    """View columns with each source table and column singly, from resolved lineage edges."""
    return edges.where("src_kind = 'base'").select("object_name", "out_col", F.col("src_name").alias("source_table"), F.col("src_col").alias("source_column")).distinct()
