"""Command line: python -m tracewell actions|references|lineage|procedures ..., each writing CSV."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tracewell.plans.actions import action_mapping, mapping_summary
from tracewell.plans.code import code_references
from tracewell.plans.lineage import success_rate, view_lineage
from tracewell.plans.procedures import column_uses
from tracewell.sinks import write_csv
from tracewell.sources.files import code_files


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tracewell")
    commands = parser.add_subparsers(dest="command", required=True)
    actions = commands.add_parser("actions", help="UI calls to routes, tables and procedures")
    actions.add_argument("--frontend", required=True)
    actions.add_argument("--backend", required=True)
    actions.add_argument("--url-variable", action="append", default=[], metavar="NAME=TEXT", help="what a URL variable of the front end stands for")
    actions.add_argument("--client", action="append", metavar="NAME", help="objects whose methods are calls (client)")
    references = commands.add_parser("references", help="tables and columns that repositories mention")
    references.add_argument("--search-dir", required=True)
    references.add_argument("--catalog", required=True, help="CSV with table_name,column_name")
    lineage = commands.add_parser("lineage", help="source columns of views")
    lineage.add_argument("--definitions", required=True, help="Parquet with view_name, ddl")
    procedures = commands.add_parser("procedures", help="columns that stored procedures use")
    procedures.add_argument("--definitions", required=True, help="Parquet with procedure_name, procedure_schema, procedure_definition")
    for command in (actions, references, lineage, procedures):
        command.add_argument("--output", required=True)
    a = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("tracewell").getOrCreate()
    if a.command == "actions":
        out = action_mapping(code_files(spark, a.frontend, ("ts", "tsx"), False), code_files(spark, a.backend, ("py",), False), bases=dict(v.split("=", 1) for v in a.url_variable), clients=tuple(a.client or ("client",)))
        write_csv(out, a.output)
        mapping_summary(out).show()
    elif a.command == "references":
        write_csv(code_references(code_files(spark, a.search_dir), spark.read.csv(a.catalog, header=True)), a.output)
    elif a.command == "lineage":
        out = view_lineage(spark, spark.read.parquet(a.definitions).select("view_name", "ddl"))
        write_csv(out, a.output)
        success_rate(out).show()
    else:
        write_csv(column_uses(spark.read.parquet(a.definitions)), a.output)


if __name__ == "__main__":
    main()
