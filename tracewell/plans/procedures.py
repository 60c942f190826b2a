"""Stored procedures: variables, language, temporary tables, cursors, dynamic SQL and the columns that they use.

A definition is read in the task that holds its row, statement by statement from its tokens; only flat rows come out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.functions.predicates import table_like_value
from tracewell.plans.sql_scopes import Scopes
from tracewell.plans.sql_text import Part, chain, is_name, is_query, is_sign, is_word, nested, split, tokens
from tracewell.schemas import PROCEDURE_COLUMNS
from tracewell.storage import dealt

STATEMENTS = ("WITH", "SELECT", "INSERT", "UPDATE", "DELETE", "MERGE", "CREATE")
#: Labels of the relationship relation.
CREATES, USES_TABLE = "PROCEDURE_CREATES_TABLE", "USES_TABLE"


def lines_of(definition: str | None) -> list[list[Part]]:
    """The tokens of each statement, flat."""
    return split(list(tokens(definition or "")), lambda t: is_sign(t, ";"))


def literal(t: Part | None) -> str | None:
    """What a quoted text says, in either kind of quotes."""
    return None if t is None or isinstance(t, list) else t.text if t.kind == "string" else t.own if t.kind == "quoted" else None


def assigned(statements: list[list[Part]]) -> dict[str, str]:
    """Names given a text by := or SET =, or a made-up one that starts with a text or name; the last one given holds."""
    found: dict[str, str] = {}
    for parts in statements:
        for i, t in enumerate(parts[:-1]):
            equals = is_sign(t, "=") and i >= 2 and is_word(parts[i - 2], "SET")
            if not (i and (is_sign(t, ":=") or equals)):
                continue
            place = i - 1
            if place >= 2 and is_word(parts[place - 2], "LET"):  # LET name type := ...
                place -= 1
            value, after = parts[i + 1], parts[i + 2 :]
            text = literal(value)
            if text is None and is_name(value) and any(is_word(x, "RANDSTR") for x in after):
                text = value.own
            if text is not None and is_name(parts[place]):
                found[parts[place].own] = text
    return found


def of_definitions(procedures: DataFrame, read: Callable[..., list[tuple]], schema: str) -> DataFrame:
    """Rows that `read` finds in each (name, schema, definition), after the name."""
    columns = ["procedure_name", *(c.split()[0] for c in schema.split(", "))]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(n, *row) for n, s, d in zip(*(frame[c] for c in frame.columns), strict=True) for row in read(s, d)]
            yield pd.DataFrame(rows, columns=columns)

    given = procedures.select("procedure_name", "procedure_schema", "procedure_definition")
    return dealt(given).mapInPandas(run, f"procedure_name string, {schema}")


def variables(procedures: DataFrame) -> DataFrame:
    """procedure_name, variable and the table-like text that it holds."""
    found = of_definitions(procedures, lambda _, d: list(assigned(lines_of(d)).items()), "variable string, value string")
    return found.where(table_like_value("value"))


def language(statements: list[list[Part]]) -> str:
    named = {parts[i + 1].text for parts in statements for i, t in enumerate(parts[:-1]) if is_word(t, "LANGUAGE") and is_name(parts[i + 1])}
    return "MIXED" if {"PYTHON", "SQL"} <= named else "PYTHON" if "PYTHON" in named else "SQL"


def created(parts: list[Part]) -> tuple[str, bool, int] | None:
    """Of a nested CREATE TABLE: the table, whether it is temporary, and where what follows the name starts."""
    at = next((i for i, t in enumerate(parts[:6]) if is_word(t, "TABLE")), None)
    if at is None or not is_word(parts[0], "CREATE"):
        return None
    temporary, i = any(is_word(t, "TEMP", "TEMPORARY") for t in parts[:at]), at + 1
    while i < len(parts) and is_word(parts[i], "IF", "NOT", "EXISTS"):
        i += 1
    name, i = relation(parts, i)
    return (name, temporary, i) if name else None


def relation(parts: list[Part], i: int) -> tuple[str | None, int]:
    """The table named from i on, IDENTIFIER(...) included, and where it ends."""
    if i >= len(parts) or not is_name(parts[i]):
        return None, i
    names, past = chain(parts, i)
    if names[-1].upper() == "IDENTIFIER" and past < len(parts) and isinstance(parts[past], list):
        inside = [t for t in parts[past] if not is_sign(t, ":")]
        text = literal(inside[0]) if inside else None
        return text or (".".join(chain(inside, 0)[0]) if inside and is_name(inside[0]) else None), past + 1
    return ".".join(names), past


def bound(parts: list[Part], values: dict[str, str]) -> list[Part]:
    """Nested tokens with IDENTIFIER(:variable) and IDENTIFIER(variable) replaced by the texts of variables (names in lower case)."""
    out: list[Part] = []
    for i, t in enumerate(parts):
        if isinstance(t, list):
            after_identifier = i and is_word(parts[i - 1], "IDENTIFIER")
            inner = [x for x in t if not is_sign(x, ":")] if after_identifier else t
            if after_identifier and len(inner) == 1 and is_name(inner[0]):
                inner = list(tokens(f"'{values.get(inner[0].own.lower(), inner[0].own)}'"))
            out.append(inner if after_identifier else bound(inner, values))
        else:
            out.append(t)
    return out


def statements_in(flat: list[Part], values: dict[str, str]) -> Iterator[list[Part]]:
    """The nested statements of a piece of a body between two semicolons: what follows BEGIN, DO, := and the like, and queries in parentheses before it."""
    try:
        parts = bound(nested(iter(flat)), values)
    except ValueError:  # not SQL: adds nothing
        return
    start = next((i for i, t in enumerate(parts) if is_word(t, *STATEMENTS) and not (is_word(t, "CREATE") and any(is_word(x, "PROCEDURE", "FUNCTION") for x in parts[i : i + 6]))), len(parts))
    for t in parts[:start]:
        if is_query(t):
            yield t
    if start < len(parts):
        yield parts[start:]


class Uses:
    """(table, column, use) of statements; a column without a qualifier belongs to the only table of its statement, if there is one."""

    def __init__(self):
        self.found: set[tuple[str, str, str]] = set()
        self.temporary: set[str] = set()

    def statement(self, parts: list[Part]) -> None:
        scopes, word = Scopes(), parts[0].text if not isinstance(parts[0], list) else "SELECT"
        place = ("main", {}, 0)
        if made := created(parts):
            name, temporary, i = made
            self.found.add((name.upper(), "*", CREATES))
            if temporary:
                self.temporary.add(name.upper())
            query = next((parts[k + 1 :] for k in range(i, len(parts)) if is_word(parts[k], "AS")), [])
            if query:
                scopes.query(query, "main", {})
        elif word == "INSERT":
            into = next((i for i, t in enumerate(parts) if is_word(t, "INTO", "TABLE")), 0)
            name, i = relation(parts, into + 1)
            if name:
                self.found.add((name.upper(), "*", "USED_AS_INSERT"))
                if i < len(parts) and isinstance(parts[i], list) and not is_query(parts[i]):
                    self.found |= {(name.upper(), c[0].own.upper(), "USED_AS_INSERT") for c in split(parts[i], lambda t: is_sign(t, ",")) if len(c) == 1 and is_name(c[0])}
                    i += 1
                if i < len(parts) and not is_word(parts[i], "VALUES"):
                    scopes.query(parts[i:], "main", {})
        elif word == "UPDATE":
            at = next((i for i, t in enumerate(parts) if is_word(t, "SET")), len(parts))
            past = next((i for i in range(at, len(parts)) if is_word(parts[i], "FROM", "WHERE")), len(parts))
            where = next((i for i in range(past, len(parts)) if is_word(parts[i], "WHERE")), len(parts))
            self._target(parts[1:at], "USED_AS_UPDATE", scopes)
            scopes._from(parts[past + 1 : where], *place)
            scopes._use("UPDATE", parts[at + 1 : past], *place)
            scopes._use("FILTER", parts[where + 1 :], *place)
        elif word == "DELETE":
            where = next((i for i, t in enumerate(parts) if is_word(t, "WHERE")), len(parts))
            using = next((i for i, t in enumerate(parts[:where]) if is_word(t, "USING")), where)
            self._target(parts[2:using], "USED_AS_DELETE", scopes)
            scopes._from(parts[using + 1 : where], *place)
            scopes._use("DELETE", parts[where + 1 :], *place)
        elif word == "MERGE":
            using = next((i for i, t in enumerate(parts) if is_word(t, "USING")), len(parts))
            on = next((i for i in range(using, len(parts)) if is_word(parts[i], "ON")), len(parts))
            self._target(parts[2:using], "USED_AS_MERGE", scopes)
            scopes._from(parts[using + 1 : on], *place)
            clauses = [t for t in parts[on + 1 :] if not is_word(t, "MATCHED", "UPDATE", "INSERT", "DELETE", "SET", "VALUES")]
            scopes._use("MERGE", clauses, *place)
        else:
            scopes.query(parts, "main", {})
        self._bind(scopes)

    def _target(self, parts: list[Part], use: str, scopes: Scopes) -> None:
        scopes._from(parts, "main", {}, 0)
        self.found |= {(s[5].upper(), "*", use) for s in scopes.sources if s[4] == "base"}

    def _bind(self, scopes: Scopes) -> None:
        base = {(s[0], s[1], s[3]): s[5] for s in scopes.sources if s[4] == "base"}
        inner = {(s[0], s[1], s[3]) for s in scopes.sources if s[4] == "scope" and not s[3].startswith("#")}
        tables = {t.upper() for t in base.values()}
        anywhere = {alias: table for (_, _, alias), table in base.items()}
        for use, scope, branch, qualifier, column in scopes.uses:
            if qualifier is not None:
                key = scope, branch, qualifier
                table = base.get(key) or (None if key in inner else anywhere.get(qualifier))
                of = {table.upper()} if table else set()
            elif column == "*":
                of = {t.upper() for (s, b, _), t in base.items() if (s, b) == (scope, branch)}
            else:
                own = {t.upper() for (s, b, _), t in base.items() if (s, b) == (scope, branch)}
                of = own if len(own) == 1 and not any(k[:2] == (scope, branch) for k in inner) else tables if len(tables) == 1 else set()
            self.found |= {(t, column.upper(), f"USED_AS_{use}") for t in of}
        self.found |= {(t, "*", USES_TABLE) for t in tables}


def used_columns(schema: str | None, definition: str | None) -> list[tuple]:
    """schema, language, table, column and use of one procedure; temporary tables are left out."""
    flat = lines_of(definition)
    values, uses = {k.lower(): v for k, v in assigned(flat).items()}, Uses()
    for piece in flat:
        for statement in statements_in([t for t in piece if not is_sign(t, "$$")], values):
            try:
                uses.statement(statement)
            except (ValueError, IndexError, AttributeError, RecursionError):  # not SQL: adds nothing
                continue
    lang = language(flat)
    return [((schema or "").upper(), lang, *row) for row in sorted(uses.found) if row[0] not in uses.temporary]


def profile(procedures: DataFrame) -> DataFrame:
    """One row for each procedure: language, temporary tables, cursors, and whether it makes SQL at run time."""

    def read(schema: str | None, definition: str | None) -> list[tuple]:
        flat = lines_of(definition)
        temps, cursors, dynamic = set(), set(), False
        for piece in flat:
            for i, t in enumerate(piece):
                if is_word(t, "CREATE") and (made := _safely(partial(created, nested_rest(piece[i:])))) and made[1]:
                    temps.add(made[0].upper())
                if is_word(t, "CURSOR") and i and is_name(piece[i - 1]) and i + 1 < len(piece) and is_word(piece[i + 1], "FOR"):
                    cursors.add(piece[i - 1].own)
                follows = piece[i + 1] if i + 1 < len(piece) else None
                dynamic |= is_word(t, "EXECUTE") and is_word(follows, "IMMEDIATE") or is_sign(t, "||") and getattr(follows, "kind", "") == "string"
                dynamic |= is_word(t, "DYNAMIC_SQL") and is_sign(follows, ":=") or is_word(t, "IDENTIFIER") and is_sign(follows, "(") and i + 2 < len(piece) and is_sign(piece[i + 2], "?")
        return [(schema, language(flat), sorted(temps), sorted(cursors), dynamic)]

    return of_definitions(procedures, read, "procedure_schema string, language string, temp_tables array<string>, cursors array<string>, dynamic_sql boolean")


def nested_rest(flat: list[Part]) -> list[Part]:
    """As much of flat as nests."""
    depth, past = 0, len(flat)
    for k, t in enumerate(flat):
        depth += is_sign(t, "(") - is_sign(t, ")")
        if depth < 0:
            past = k
            break
    opened = [k for k in range(past) if is_sign(flat[k], "(")]
    while depth > 0 and opened:
        past, depth = opened.pop(), depth - 1
    return _safely(lambda: nested(iter(flat[:past]))) or []


def _safely(read: Callable):
    try:
        return read()
    except (ValueError, IndexError):
        return None


def column_uses(procedures: DataFrame) -> DataFrame:
    """PROCEDURE_COLUMNS of a table of procedures (procedure_name, procedure_schema, procedure_definition)."""
    found = of_definitions(procedures, used_columns, "sp_schema string, sp_language string, table_name string, column_name string, use string")
    keys = [F.upper("procedure_name").alias("sp_name"), "sp_schema", "sp_language", "table_name", "column_name"]
    out = found.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("use")), ",").alias("relationship_types"))
    return out.select(*(c.strip().split()[0] for c in PROCEDURE_COLUMNS.split(",")))
