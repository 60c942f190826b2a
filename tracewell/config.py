"""Settings that the relations and analyzers share. All are defaults of parameters."""

from __future__ import annotations

from dataclasses import dataclass

# Names and markers of the data contract.
SP_BLACKLIST = ("IDENTIFIER", "logged_user", "", "NULL", "null")
UNKNOWN_COLUMN = "unknown"
NULL_NAMES = ("", "nan", "none")
IGNORED_DIRECTORIES = ("__pycache__", "node_modules", ".git", ".venv", "venv", "env", ".pytest_cache", "dist", "build")
SCAN_EXTENSIONS = ("py", "json", "js", "ts", "java", "scala", "r", "sh", "cfg", "conf", "ini", "properties", "sql", "yml", "yaml")
SEARCH_EXTENSIONS = SCAN_EXTENSIONS[:12]
SERVED_RELATIONS = (
    "BASE_NAMES", "VIEW_NAMES", "BASE_TABLE", "VIEW_TABLE", "VIEW_TO_SOURCE_COLUMN_LINEAGE", "VIEW_TO_SOURCE_COLUMN_LINEAGE_V",
    "ACTION_TO_ENDPOINTS_TABLES_MAPPING", "ACTION_TO_ENDPOINTS_TABLES_MAPPING_V", "THOUGHTSPOT_TABLE", "THOUGHTSPOT_TABLE_V",
    "SP_TABLE_COLUMN_MAPPING", "SP_TABLE_COLUMN_MAPPING_V", "SP_REFERENCE_TO_FLOWS", "SP_MAPPING_WITH_ENDPOINTS_AND_FLOWS_V",
    "PREFECT_REFERENCE_WITH_TABLES_COLUMNS", "PREFECT_REFERENCE_WITH_TABLES_COLUMNS_V",
)


@dataclass(frozen=True)
class Catalog:
    """How catalog scans choose objects and schemas."""

    schemas: tuple[str, ...] = ()
    excluded_like: tuple[str, ...] = ()
    priority: tuple[str, ...] = ()


@dataclass(frozen=True)
class Limits:
    """Bounds of the serving interface."""

    default_rows: int = 100
    most_rows: int = 10_000
    matches: int = 10
    sample_rows: int = 100
