"""Scans of the catalog: objects, columns, and where a name lives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.config import Catalog
from tracewell.functions.names import name_parts


def objects(tables: DataFrame, catalog: Catalog, include_views: bool = True) -> DataFrame:
    """Tables and views (table_name, table_schema, table_type) of the schemas, less the excluded, in order."""
    kinds = ["BASE TABLE", "VIEW"] if include_views else ["BASE TABLE"]
    keep = F.col("table_type").isin(kinds)
    if catalog.schemas:
        keep = keep & F.col("table_schema").isin(*catalog.schemas)
    for pattern in catalog.excluded_like:
        keep = keep & ~F.col("table_name").like(pattern)
    return tables.where(keep).orderBy("table_schema", "table_name")


def view_names(tables: DataFrame, catalog: Catalog) -> DataFrame:
    return objects(tables, catalog).where("table_type = 'VIEW'").select("table_name")


def _rank(schema: Column, priority: tuple[str, ...]) -> Column:
    ranks = reduce(lambda done, p: done.when(F.upper(schema) == p[1].upper(), p[0]), enumerate(priority), F.when(F.lit(False), 0)) if priority else F.lit(None).cast("int")
    return F.coalesce(ranks, F.lit(len(priority)))


def preferred_schema(tables: DataFrame, priority: tuple[str, ...]) -> DataFrame:
    """The schema of each name: the first by priority, else the first of any."""
    return tables.groupBy("table_name").agg(F.min_by("table_schema", F.struct(_rank(F.col("table_schema"), priority), "table_schema")).alias("table_schema"))


def locate(names: DataFrame, tables: DataFrame, priority: tuple[str, ...], name: str = "table_name") -> DataFrame:
    """Each name of one to three parts with its object in (table_catalog, table_schema, table_name, table_type), in any case.

    A named database and schema come first, then the named schema, then the priority list, then any; what is not found is NOT_FOUND.
    """
    asked = names.select(F.col(name).alias("asked")).distinct().withColumn("_p", name_parts("asked"))
    found = asked.join(tables, F.upper("_p.table") == F.upper(tables["table_name"]), "left")
    alike = lambda part, c: F.coalesce(F.upper(f"_p.{part}") == F.upper(c), F.lit(False))
    in_schema, in_db = alike("schema", "table_schema"), alike("db", "table_catalog")
    tier = F.when(in_schema & in_db, 0).when(in_schema, 1).otherwise(2)
    order = F.struct(tier, _rank(F.col("table_schema"), priority), "table_schema", "table_catalog")
    best = found.groupBy("asked").agg(F.min_by(F.struct("table_catalog", "table_schema", "table_name", "table_type"), order).alias("at"))
    return best.select(F.col("asked").alias(name), F.col("at.table_catalog").alias("found_catalog"), F.col("at.table_schema").alias("found_schema"), F.coalesce("at.table_type", F.lit("NOT_FOUND")).alias("table_type"))


def column_metadata(names: DataFrame, tables: DataFrame, columns: DataFrame, priority: tuple[str, ...], name: str = "table_name") -> DataFrame:
    """One row for each column (column_name, ordinal, data_type, is_key) of each name; a name that isn't found keeps one row."""
    at = locate(names, tables, priority, name)
    c = columns.select(F.upper("table_schema").alias("_s"), F.upper("table_name").alias("_t"), F.col("column_name").alias("column_names"), "ordinal", F.col("data_type").alias("type"), F.when(F.col("is_key"), "Y").otherwise("N").alias("primary_key_reference"))
    found = at.join(c, (F.upper(at["found_schema"]) == c["_s"]) & (F.upper(F.col(name)) .endswith(c["_t"])) & (F.upper(F.split_part(F.col(name), F.lit("."), F.lit(-1))) == c["_t"]), "left")
    return found.select(F.col(name), "table_type", "column_names", "ordinal", "type", F.when(F.col("column_names").isNotNull(), "COLUMN").alias("relationship_kind"), "primary_key_reference", F.col("found_schema").alias("schema_name"))


def described(df: DataFrame) -> list[tuple[str, str, bool]]:
    """Name, type and nullability of the columns, in order."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]


def view_definitions(spark: SparkSession, schemas: list[str], pattern: str = "*") -> DataFrame:
    """view_name (schema.name) and ddl of the session catalog's views in the schemas that the pattern fits: one listing for each schema, no call for each view.

    The DDL is put together from the names of the view's columns and its text. Tables and temporary views are left out.
    """
    quoted = lambda name: "`" + name.replace("`", "``") + "`"
    listed = [spark.sql(f"SHOW TABLE EXTENDED IN {quoted(s)} LIKE '{_escaped(pattern)}'") for s in dict.fromkeys(schemas)]
    if not listed:
        return spark.createDataFrame([], "view_name string, ddl string")
    about = F.col("information")
    views = reduce(DataFrame.unionByName, listed).where(~F.col("isTemporary") & F.regexp_like(about, F.lit(r"(?m)^Type: VIEW$")))
    columns = F.transform(F.regexp_extract_all(F.split_part(about, F.lit("\nSchema: root\n"), F.lit(-1)), F.lit(r"(?m)^ \|-- (.*?): "), 1), lambda c: F.concat(F.lit("`"), F.replace(c, F.lit("`"), F.lit("``")), F.lit("`")))
    body = F.regexp_extract(about, r"(?s)\nView Text: (.*?)\nView Original Text: ", 1)
    name = F.concat_ws(".", "namespace", "tableName")
    return views.select(name.alias("view_name"), F.concat(F.lit("CREATE VIEW "), name, F.lit(" ("), F.array_join(columns, ", "), F.lit(") AS "), body).alias("ddl"))


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def procedures_like(procedures: DataFrame, part: str) -> DataFrame:
    """Procedures (procedure_name, procedure_schema, procedure_definition) whose schema has the part, as written, in its name."""
    return procedures.where(F.col("procedure_schema").contains(part)).select("procedure_name", "procedure_definition", "procedure_schema")


def procedure_names(procedures: DataFrame) -> DataFrame:
    """Distinct names, in order."""
    return procedures.where(F.col("procedure_name").isNotNull()).select("procedure_name").distinct().orderBy("procedure_name")


def definitions_of(names: DataFrame, definitions: DataFrame, tables: DataFrame, priority: tuple[str, ...]) -> DataFrame:
    """view_name and ddl of asked names, in one join: definitions (table_schema, table_name, ddl) of the object that locate() finds; null where there is none."""
    at = locate(names, tables, priority, "view_name")
    d = definitions.select(F.upper("table_schema").alias("_s"), F.upper("table_name").alias("_t"), "ddl")
    last = F.upper(F.split_part("view_name", F.lit("."), F.lit(-1)))
    return at.join(d, (F.upper(at["found_schema"]) == d["_s"]) & (last == d["_t"]), "left").groupBy("view_name").agg(F.min("ddl").alias("ddl"))
