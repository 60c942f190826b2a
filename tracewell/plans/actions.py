"""From front-end and back-end code to the action mapping: which UI call reaches which route, tables, columns and procedures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.config import UNKNOWN_COLUMN
from tracewell.functions.names import model_name
from tracewell.operators.joins import match_routes
from tracewell.operators.ranking import numbered
from tracewell.plans.code import PrefixRule, backend_routes, frontend_calls, known_tables, model_fields, nested_fields, orm_classes, orm_columns
from tracewell.plans.python_code import call_facts, function_uses, router_prefixes
from tracewell.sinks import mapping_rows
from tracewell.storage import stored


def _file(path: str) -> Column:
    return F.element_at(F.split(F.col(path), "/"), -1)


def _joined(uses: DataFrame, kind: str, to: str, delimiter: str) -> DataFrame:
    return uses.where(F.col("kind") == kind).groupBy("path", "function").agg(F.array_join(F.array_sort(F.collect_set("name")), delimiter).alias(to))


def table_details(uses: DataFrame, columns: DataFrame) -> DataFrame:
    """path, function and `T1:[c1,c2];T2:[unknown]` of the tables that it uses; columns: table_name, column_name."""
    tables = uses.where("kind = 'table'").select("path", "function", F.col("name").alias("table_name")).distinct()
    listed = columns.groupBy("table_name").agg(F.array_sort(F.collect_set("column_name")).alias("columns"))
    found = tables.join(listed, "table_name", "left").withColumn("columns", F.coalesce("columns", F.array(F.lit(UNKNOWN_COLUMN))))
    text = F.concat("table_name", F.lit(":["), F.array_join("columns", ","), F.lit("]"))
    return found.groupBy("path", "function").agg(F.array_join(F.array_sort(F.collect_list(text)), ";").alias("table_column_details"))


def response_fields(files: DataFrame) -> DataFrame:
    """model with its own fields and the dotted fields of models inside it, as lists."""
    dotted = nested_fields(model_fields(files))
    inner = F.col("dotted").contains(".")
    own, nested = (F.array_sort(F.collect_set(F.when(c, F.col("dotted")))) for c in (~inner, inner))
    return dotted.groupBy("model").agg(F.array_join(own, ",").alias("response_fields"), F.array_join(nested, ",").alias("nested_fields"))


def action_mapping(frontend: DataFrame, backend: DataFrame, prefixes: Sequence[PrefixRule | tuple[str, str]] = (), bases: Mapping[str, str] = MappingProxyType({}), clients: tuple[str, ...] = ("client",), procedure_class: str = "", procedures: DataFrame | None = None, base: str = "") -> DataFrame:
    """The fourteen columns of the mapping, a row for each front-end call; what has no route has empty strings.

    frontend, backend: path and content of code files. Routes are tried in the order of path and line. procedure_class,
    procedures: the class whose attributes are procedures, and functions that stand for procedures (function, name). base: a path
    that calls and routes may or may not begin with.
    """
    calls = frontend_calls(frontend, bases=bases, clients=clients)
    facts = stored(call_facts(backend, procedure_class), "facts")
    routes = numbered(backend_routes(backend, prefixes, router_prefixes(facts)), "place", F.col("path"), F.col("line"))
    matched = match_routes(calls, routes, "url", "route", "method", "place", base=base)
    uses = function_uses(facts, known_tables(backend), orm_classes(backend), procedures=procedures)
    details = table_details(uses, orm_columns(backend).select("table_name", "column_name"))
    fields = response_fields(backend)
    rows = matched
    for part in (_joined(uses, "table", "database_tables", ";"), _joined(uses, "procedure", "stored_procedures", ","), _joined(uses, "flow", "flow_calls", ","), details):
        rows = rows.join(part.withColumnsRenamed({"path": "route_path", "function": "route_function"}), ["route_path", "route_function"], "left")
    rows = rows.withColumn("model", model_name("route_response_model")).join(fields, "model", "left")
    return mapping_rows(rows.select(
        _file("path").alias("frontend_file"), F.col("function").alias("frontend_function"), F.col("method").alias("http_method"), F.col("url").alias("frontend_url"),
        _file("route_path").alias("backend_file"), F.col("route_function").alias("backend_function"), F.col("route_route").alias("backend_route"), "database_tables", "stored_procedures",
        "flow_calls", F.col("route_response_model").alias("response_model"), "response_fields", "nested_fields", "table_column_details",
    ))


def mapping_summary(mapping: DataFrame) -> DataFrame:
    """How many calls there are, and how many have a route, tables and procedures, with percentages."""
    from tracewell.operators.aggregates import percentages

    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    return percentages(mapping, matched=filled("backend_function"), with_tables=filled("database_tables"), with_procedures=filled("stored_procedures"))
