"""Boolean column expressions: what is kept, and what looks like a table or like SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracewell.config import SP_BLACKLIST
from tracewell.functions.names import col

# The keywords of the plausibility tests.
SQL_WORDS = ("SELECT", "FROM", "WHERE", "JOIN", "INSERT", "UPDATE", "DELETE", "CREATE", "GROUP BY", "ORDER BY", "UNION")
GATE_WORDS = ("SELECT", "FROM", "JOIN", "INSERT", "UPDATE", "DELETE")
SQL_PATTERNS = (r"select\s+.+\s+from\s", r"insert\s+into\s", r"update\s+\S+\s+set\s", r"delete\s+from\s", r"with\s+\w+\s+as\s*\(")
KEYWORDS = ("SELECT", "FROM", "WHERE", "JOIN", "INNER", "LEFT", "RIGHT", "OUTER", "FULL", "CROSS", "ON", "AND", "OR", "NOT", "IN", "IS", "NULL", "AS", "BY", "GROUP", "ORDER", "HAVING", "UNION", "ALL", "DISTINCT", "SET", "VALUES", "INTO", "CASE", "WHEN", "THEN", "ELSE", "END", "LIMIT", "WITH", "TABLE", "LATERAL", "USING")


def matches(c: str | Column, pattern: str) -> Column:
    """A regular expression found in any case; null is false."""
    return F.coalesce(col(c).rlike(f"(?i){pattern}"), F.lit(False))


def any_column_contains(columns: list[str], term: str) -> Column:
    """A term, in any case, in the row's non-null values joined by blanks."""
    return F.lower(F.concat_ws(" ", *(F.col(c).cast("string") for c in columns))).contains(term.lower())


def procedure_name(c: str | Column) -> Column:
    """Not one of the stand-ins that analyzers leave for procedures without a name."""
    return F.coalesce(~F.trim(col(c)).isin(*SP_BLACKLIST), F.lit(False))


def table_candidate(c: str | Column, ctes: Column | None = None) -> Column:
    """A name that SQL text may mean as a table: 3 letters or more, no keyword, CTE or number; upper case, with _, or a long capitalised word."""
    name = col(c)
    shape = (name == F.upper(name)) | name.contains("_") | (name.rlike("^[A-Z]") & (F.length(name) > 4))
    ok = (F.length(name) >= 3) & ~F.upper(name).isin(*KEYWORDS) & ~name.rlike("^[0-9]+$") & shape
    return ok if ctes is None else ok & ~F.array_contains(F.transform(ctes, F.upper), F.upper(name))


def likely_table(c: str | Column) -> Column:
    """Stricter, for constants in code: all upper case with _ or over 5 letters, or with both _ and a capital."""
    name = col(c)
    upper = (name == F.upper(name)) & name.rlike("[A-Z]")
    return (F.length(name) >= 3) & ~F.upper(name).isin(*KEYWORDS) & ((upper & (name.contains("_") | (F.length(name) > 5))) | (name.contains("_") & name.rlike("[A-Z]")))


def looks_like_sql(c: str | Column) -> Column:
    """Two keywords, or a clause that only SQL has."""
    upper = F.upper(col(c))
    count = reduce(Column.__add__, (upper.contains(w).cast("int") for w in SQL_WORDS))
    return (count >= 2) | reduce(Column.__or__, (matches(c, f"(?s){p}") for p in SQL_PATTERNS))


def sql_gate(c: str | Column) -> Column:
    """A string of code that is worth reading as SQL."""
    return (F.length(F.trim(col(c))) > 20) & matches(c, "(?:" + "|".join(GATE_WORDS) + ")")


def table_like_value(c: str | Column) -> Column:
    return (F.length(col(c)) > 3) & (col(c).contains("_") | col(c).contains("."))
