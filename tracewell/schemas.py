"""Schemas of the relations, as Spark DDL. All columns are nullable."""

from __future__ import annotations

from pyspark.sql import types as T

BASE_NAMES = "base_primary_id int, table_name string"
VIEW_NAMES = "view_primary_id int, view_name string"
BASE_TABLE = "primary_key int, table_name string, table_type string, column_names string, type string, relationship_kind string, primary_key_reference string, schema_name string, base_primary_id int"
VIEW_TABLE = "primary_key int, view_name string, column_names string, type string, schema_name string"
TABLE_TYPES = "table_name string, table_type string"
LINEAGE = "view_name string, view_column string, column_type string, source_table string, source_column string, expression_type string"
ACTION_MAPPING = (
    "frontend_file string, frontend_function string, http_method string, frontend_url string, backend_file string, backend_function string, backend_route string, "
    "database_tables string, stored_procedures string, flow_calls string, response_model string, response_fields string, nested_fields string, table_column_details string"
)
DASHBOARDS = "table_name string, liveboard_name string, guid string, schema_name string, type string"
PROCEDURE_COLUMNS = "sp_name string, sp_schema string, sp_language string, table_name string, column_name string, relationship_types string"
PROCEDURE_FLOWS = "sp_name string, file_path string, repo_name string"
REPO_REFERENCES = "repo_name string, function_name string, table_name string, column_name string, file_name string"

#: Older headers of the same columns.
RENAMED = {
    "tables": "database_tables", "table_columns": "table_column_details", "liveboard": "liveboard_name", "schema": "schema_name",
    "table_column": "column_names",
}


def parse_type(text: str | None) -> T.DataType:
    """The Spark type of a warehouse type's name; unknown ones are strings."""
    name, _, rest = (text or "").strip().upper().partition("(")
    sizes = [int(x) for x in rest.rstrip(") ").split(",") if x.strip().isdigit()]
    if name in ("NUMBER", "DECIMAL", "NUMERIC"):
        return T.DecimalType(*(sizes + [38, 0][len(sizes) :])[:2])
    simple = {
        "DATE": T.DateType(), "BOOLEAN": T.BooleanType(), "FLOAT": T.DoubleType(), "DOUBLE": T.DoubleType(), "REAL": T.DoubleType(),
        "INT": T.DecimalType(38, 0), "INTEGER": T.DecimalType(38, 0), "BIGINT": T.DecimalType(38, 0), "BINARY": T.BinaryType(),
        "TIMESTAMP_NTZ": T.TimestampNTZType(), "DATETIME": T.TimestampNTZType(), "TIMESTAMP_TZ": T.TimestampType(), "TIMESTAMP_LTZ": T.TimestampType(),
        "VARIANT": T.VariantType(), "OBJECT": T.VariantType(), "ARRAY": T.VariantType(),
    }
    return simple.get(name, T.StringType())
