"""References in code: SQL in source files, Python classes and functions, front-end calls and back-end routes.

Where a regular expression says it, it is a column expression. Syntax trees and brace counting are small functions of one
file's text, run by mapInPandas over (path, content); what they find are flat rows, joined and closed over by Spark.
"""

from __future__ import annotations

import ast
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import count
from types import MappingProxyType
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.names import normal_url
from tracewell.functions.predicates import sql_gate, table_candidate
from tracewell.operators.closure import ROUNDS
from tracewell.operators.joins import enclosing_range
from tracewell.plans.code_tokens import BRACES, Innermost, Range, function_ranges, mask, pairs
from tracewell.storage import dealt, stored

ALIASES = r"(?i)\b(?:FROM|JOIN)\s+([\w.]+)(?:\s+AS)?\s+(?!(?:ON|WHERE|LEFT|RIGHT|INNER|OUTER|FULL|CROSS|JOIN|GROUP|ORDER|HAVING|LIMIT|UNION|SET|USING|VALUES|SELECT)\b)(\w+)"
TABLES = r"(?i)\b(?:FROM|JOIN|UPDATE|INTO)\s+([\w.]+)"
QUALIFIED = r"\b([A-Za-z_]\w*)\.([A-Za-z_]\w*)\b"
SYSTEM_NAMES = ("INFORMATION_SCHEMA", "SYS", "DUAL", "PUBLIC", "SELF", "OS", "NP")
OPERANDS = r"(?i)\b([A-Za-z_]\w*)\s*(?:!=|<>|<=|>=|=|<|>|\bBETWEEN\b|\bIN\b|\bIS\b|\bLIKE\b)"
OPERAND_WORDS = ("AND", "OR", "NOT", "WHERE", "ON", "SET", "CASE", "WHEN", "NULL")
SKIPPED_CALLS = ("print", "len", "str", "int", "float", "list", "dict", "set", "tuple", "range", "isinstance", "getattr", "setattr", "hasattr", "super", "sorted", "min", "max", "sum", "any", "all", "zip", "map", "filter", "enumerate", "type", "open")

def by_file(files: DataFrame, read: Callable[[str], list[tuple]], schema: str) -> DataFrame:
    """Rows that `read` finds in each file's content, after its path."""
    columns = ["path", *(c.strip().split()[0] for c in re.sub(r"<[^>]*>", "", schema).split(","))]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([(p, *row) for p, c in zip(frame["path"], frame["content"], strict=True) for row in read(c or "")], columns=columns)

    return dealt(files.select("path", "content")).mapInPandas(run, f"path string, {schema}")


def line_numbers(content: str) -> Callable[[int], int]:
    """Lines, from 1, of places in a text."""
    ends = [m.start() for m in re.finditer("\n", content)]
    return lambda at: bisect_left(ends, at) + 1


def parsed(content: str) -> ast.Module | None:
    try:
        return ast.parse(content)
    except (SyntaxError, ValueError, RecursionError):
        return None


# SQL in source files

def python_texts(content: str) -> list[tuple[int, str]]:
    """Line and value of the texts in a syntax tree; what an f-string is filled with is a blank in it."""
    root = parsed(content)
    found, inside = [], set()
    for n in ast.walk(root) if root is not None else ():
        if isinstance(n, ast.JoinedStr):
            inside.update(map(id, n.values))
            found.append((n.lineno, " ".join(v.value if isinstance(v, ast.Constant) else " " for v in n.values)))
        elif isinstance(n, ast.Constant) and isinstance(n.value, str) and id(n) not in inside:
            found.append((n.lineno, n.value))
    return found


def sql_strings(files: DataFrame) -> DataFrame:
    """path, line and sql of the texts that are worth reading as SQL: literals, and files of SQL statement by statement."""
    def literals(extension: str) -> Callable[[str], list[tuple]]:
        def find(content: str) -> list[tuple]:
            line, (_, strings) = line_numbers(content), mask(content, extension)
            return [(line(a), content[a:b].strip("\"'`").strip()) for a, b in strings]

        return find

    def statements(content: str) -> list[tuple]:
        line = line_numbers(content)
        return [(line(m.start()), m[0].strip()) for m in re.finditer(r"[^;\s][^;]*", content)]

    schema = "line long, sql string"
    is_ = lambda *names: F.col("extension").isin(*names)
    found = by_file(files.where(is_("py")), lambda c: [(k, t.strip()) for k, t in python_texts(c)], schema)
    found = found.unionByName(by_file(files.where(is_("sql")), statements, schema))
    for extension in ("r", "sh"):
        found = found.unionByName(by_file(files.where(is_(extension)), literals(extension), schema))
    others = files.where(~F.coalesce(is_("py", "sql", "r", "sh"), F.lit(False)))
    return found.unionByName(by_file(others, literals("ts"), schema)).where(sql_gate("sql")).distinct()


def alias_map(sqls: DataFrame) -> DataFrame:
    """path, line, alias and table of FROM and JOIN; a table is an alias of itself."""
    up = F.upper(F.regexp_replace("sql", r"\s+", " "))
    last = lambda c: F.split_part(c, F.lit("."), F.lit(-1))
    pairs = F.transform(F.arrays_zip(F.regexp_extract_all(up, F.lit(ALIASES), 1).alias("t"), F.regexp_extract_all(up, F.lit(ALIASES), 2).alias("a")), lambda p: F.struct(p["a"].alias("alias"), last(p["t"]).alias("table_name")))
    own = F.transform(F.regexp_extract_all(up, F.lit(TABLES), 1), lambda t: F.struct(last(t).alias("alias"), last(t).alias("table_name")))
    return sqls.select("path", "line", F.explode(F.concat(own, pairs)).alias("x")).select("path", "line", "x.*").distinct()


def column_mentions(sqls: DataFrame) -> DataFrame:
    """path, line, qualifier (null: none) and column of what a statement selects, compares, inserts or sets."""
    up = F.upper(F.regexp_replace("sql", r"\s+", " "))
    none = F.lit(None).cast("string")
    plain = lambda cols: F.transform(cols, lambda c: F.struct(none.alias("qualifier"), F.trim(c).alias("column")))
    qualified = F.transform(F.arrays_zip(F.regexp_extract_all(up, F.lit(QUALIFIED), 1).alias("q"), F.regexp_extract_all(up, F.lit(QUALIFIED), 2).alias("c")), lambda p: F.struct(p["q"].alias("qualifier"), p["c"].alias("column")))
    selected = F.flatten(F.transform(F.regexp_extract_all(up, F.lit(r"SELECT (?:DISTINCT )?(.*?) FROM "), 1), lambda s: F.split(s, ",")))
    selected = F.filter(F.transform(selected, F.trim), lambda c: c.rlike(r"^[A-Z_]\w*$"))
    operands = F.filter(F.regexp_extract_all(up, F.lit(OPERANDS), 1), lambda c: ~c.isin(*OPERAND_WORDS))
    inserted = F.flatten(F.transform(F.regexp_extract_all(up, F.lit(r"INSERT INTO [\w.]+ ?\(([^)]*)\)"), 1), lambda s: F.split(s, ",")))
    rows = sqls.select("path", "line", F.explode(F.concat(qualified, plain(selected), plain(operands), plain(inserted))).alias("x")).select("path", "line", "x.*")
    deleted = sqls.select("path", "line", F.explode(F.regexp_extract_all(up, F.lit(r"DELETE FROM ([\w.]+)"), 1)).alias("t")).select("path", "line", F.split_part("t", F.lit("."), F.lit(-1)).alias("qualifier"), F.lit("").alias("column"))
    return rows.where(F.col("qualifier").isNull() | ~F.col("qualifier").isin(*SYSTEM_NAMES)).unionByName(deleted).distinct()


def functions(files: DataFrame) -> DataFrame:
    """path, function_name, first_line, last_line and place (outer ones first) of functions, in Python by its syntax tree, else by tokens and brackets."""
    def python(content: str) -> list[tuple]:
        root = parsed(content)
        if root is None:
            return []
        return [(n.name, n.lineno, n.end_lineno, k) for k, n in enumerate(x for x in ast.walk(root) if isinstance(x, ast.FunctionDef | ast.AsyncFunctionDef))]

    def other(extension: str) -> Callable[[str], list[tuple]]:
        def find(content: str) -> list[tuple]:
            code, _ = mask(content, extension)
            line = line_numbers(content)
            return [(r.name, line(r.begin), line(r.end - 1), k) for k, r in enumerate(function_ranges(code, pairs(code), extension))]

        return find

    schema = "function_name string, first_line long, last_line long, place long"
    found = by_file(files.where("extension = 'py'"), python, schema)
    for extension in BRACES:
        found = found.unionByName(by_file(files.where(F.col("extension") == extension), other(extension), schema))
    return found


def code_references(files: DataFrame, catalog: DataFrame) -> DataFrame:
    """REPO_REFERENCES: tables and columns of the catalog (table_name, column_name) that files mention, and the function that does.

    A qualified column counts for its alias's table; an unqualified one for every table of the statement that has it. A
    file without SQL counts by its words: tables named in it, and their columns named in it, where these stand.
    """
    sqls = sql_strings(files)
    known = catalog.select(F.upper("table_name").alias("table_name"), F.upper("column_name").alias("column")).where("table_name is not null").distinct()
    aliases = alias_map(sqls)
    tables = known.select("table_name").distinct()
    mentions = column_mentions(sqls)
    at = ["path", "line"]
    direct = mentions.where("qualifier is not null").join(aliases, [mentions[c] == aliases[c] for c in at] + [mentions["qualifier"] == aliases["alias"]]).select(mentions["path"], mentions["line"], "table_name", "column")
    spread = mentions.where("qualifier is null").join(aliases.select("path", "line", "table_name").distinct(), at).select("path", "line", "table_name", "column")
    columns = direct.where("column != ''").unionByName(spread).join(known, ["table_name", "column"])
    whole = direct.where("column = ''").join(tables, "table_name").select("table_name", "column", "path", "line")
    found = columns.select("table_name", "column", "path", "line").unionByName(whole).distinct()

    bare = files.join(sqls.select("path").distinct(), "path", "left_anti").select("path", F.posexplode(F.split(F.upper("content"), "\n")).alias("line", "text"))
    bare = bare.select("path", (F.col("line") + 1).cast("long").alias("line"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(\w+)"), 1))).alias("word"))
    named = bare.join(tables, bare["word"] == tables["table_name"]).select("path", "table_name").distinct()
    words = named.join(known, "table_name").join(bare.withColumnRenamed("word", "column"), ["path", "column"]).select("table_name", "column", "path", "line")

    ranges = functions(files)
    placed = enclosing_range(found.unionByName(words.distinct()), ranges.where("first_line is not null"), "path", "line", "first_line", "last_line", "place")
    first = ranges.groupBy("path").agg(F.min_by("function_name", "place").alias("first_function"))
    where = files.select("path", "repo_name", "file_name")
    return placed.join(first, "path", "left").join(where, "path").select("repo_name", F.coalesce("function_name", "first_function", F.lit("main_content")).alias("function_name"), "table_name", F.col("column").alias("column_name"), "file_name").distinct()


def sql_tables(c: str | Column) -> Column:
    """Table names after the clauses that take one, less the statement's own CTEs."""
    text = F.col(c) if isinstance(c, str) else c
    found = F.regexp_extract_all(text, F.lit(r"(?i)\b(?:FROM|JOIN|UPDATE|INSERT\s+INTO|MERGE\s+INTO|DELETE\s+FROM)\s+([A-Za-z0-9_]+)(?=[\s),;]|$)"), 1)
    ctes = F.regexp_extract_all(text, F.lit(r"(?i)(?:\bWITH|,)\s+([A-Za-z0-9_]+)\s+AS\s*\("), 1)
    return F.array_sort(F.array_distinct(F.filter(found, lambda t: table_candidate(t, ctes))))


# Python classes

def orm_columns(files: DataFrame) -> DataFrame:
    """path, table_name and column_name of mapped classes, in upper case; private fields and relationships are none."""
    def find(content: str) -> list[tuple]:
        rows = []
        for c in (n for n in ast.walk(parsed(content) or ast.Module([], [])) if isinstance(n, ast.ClassDef)):
            named = [s.value.value for s in c.body if isinstance(s, ast.Assign) and isinstance(s.value, ast.Constant) and any(isinstance(t, ast.Name) and t.id == "__tablename__" for t in s.targets)]
            for s in c.body if named else ():
                related = isinstance(s, ast.AnnAssign) and isinstance(s.value, ast.Call) and isinstance(s.value.func, ast.Name) and s.value.func.id == "relationship"
                if isinstance(s, ast.AnnAssign) and isinstance(s.target, ast.Name) and not s.target.id.startswith("_") and not related:
                    rows.append((str(named[0]).upper(), s.target.id.upper()))
        return rows

    return by_file(files, find, "table_name string, column_name string").distinct()


def orm_classes(files: DataFrame) -> DataFrame:
    """class and table_name of mapped classes; of classes with one name, the last by path."""
    def find(content: str) -> list[tuple]:
        classes = (n for n in ast.walk(parsed(content) or ast.Module([], [])) if isinstance(n, ast.ClassDef))
        return [(c.name, str(s.value.value)) for c in classes for s in c.body if isinstance(s, ast.Assign) and isinstance(s.value, ast.Constant) and any(isinstance(t, ast.Name) and t.id == "__tablename__" for t in s.targets)]

    found = by_file(files, find, "class string, table_name string")
    return found.groupBy("class").agg(F.max_by("table_name", F.struct("path", "table_name")).alias("table_name"))


def model_fields(files: DataFrame) -> DataFrame:
    """path, model, field, annotation and whether it is optional, of classes named as models of responses."""
    def find(content: str) -> list[tuple]:
        classes = (n for n in ast.walk(parsed(content) or ast.Module([], [])) if isinstance(n, ast.ClassDef) and re.search("Read|Response|Model|Output", n.name))
        return [(c.name, s.target.id, a := ast.unparse(s.annotation), bool(re.search(r"\bOptional\b|\bNone\b", a))) for c in classes for s in c.body if isinstance(s, ast.AnnAssign) and isinstance(s.target, ast.Name)]

    return by_file(files, find, "model string, field string, annotation string, optional boolean").distinct()


def nested_fields(fields: DataFrame) -> DataFrame:
    """Fields of models inside models, however deep: model, path of the field in dots. A model inside itself ends there."""
    from tracewell.functions.names import model_name

    typed = stored(fields.select("model", "field", model_name("annotation").alias("inner")).distinct(), "fields")
    found = level = typed.select("model", F.col("field").alias("dotted"), "inner", F.array("model").alias("seen"))
    deeper = typed.select(F.col("model").alias("inner"), F.col("field").alias("_f"), F.col("inner").alias("_i"))
    for n in count(1):
        level = level.join(deeper, "inner").where(~F.array_contains("seen", F.col("inner"))).select("model", F.concat("dotted", F.lit("."), "_f").alias("dotted"), F.col("_i").alias("inner"), F.concat("seen", F.array("inner")).alias("seen"))
        level = stored(level, "nested-fields")
        if level.isEmpty():
            break
        found = found.unionByName(level)
        if n % ROUNDS == 0:
            found = stored(found, "nested-fields")
    return found.select("model", "dotted")


def known_tables(files: DataFrame) -> DataFrame:
    """Names that code declares as tables."""
    forms = [r"""__tablename__\s*=\s*["'](\w+)["']""", r"""\bTable\(\s*["'](\w+)["']""", r"""["'](\w+)["']\s*,\s*\w*Base\.metadata"""]
    return files.select("path", F.explode(F.concat(*(F.regexp_extract_all("content", F.lit(p), 1) for p in forms))).alias("table_name")).distinct()


# Front end and routes

def frontend_calls(files: DataFrame, bases: Mapping[str, str] = MappingProxyType({}), clients: tuple[str, ...] = ("client",)) -> DataFrame:
    """path, line, function, method and url of API calls; calls in comments and strings and downloads of blobs are none.

    A call belongs to the innermost function around it, else to `unknown`. Its URL is the first text like one between its
    parentheses, or the text given before, in a function around the call or outside of all, to the variable there.
    bases: texts of URL variables. clients: names of the objects whose methods are calls.
    """
    call_of = re.compile(rf"""(?<![\w$])(?:{"|".join(map(re.escape, clients))})\s*(?:\??\.\s*(get|post|put|patch|delete)|\[\s+\])\s*(?:<[^()]{{0,80}}>)?\s*\(""", re.I)
    given = re.compile(r"([\w$]+)\s*(?::[^=;:\n]{1,80})?=(?![=>])")

    def like_url(u: str) -> bool:
        return u.startswith("/") or "${" in u or "api" in u or "workflow" in u

    def find(content: str) -> list[tuple]:
        code, strings = mask(content, "ts")
        closing, line = pairs(code), line_numbers(content)
        inside = Innermost(function_ranges(code, closing, "ts"))
        begins = [a for a, _ in strings]

        def texts(a: int, b: int) -> Iterator[str]:
            for k in range(bisect_left(begins, a), bisect_left(begins, b)):
                yield content[strings[k][0] + 1 : strings[k][1] - 1]

        assigned: dict[str, list[tuple[int, Range | None, str]]] = {}
        for m in given.finditer(code):
            k = bisect_left(begins, m.end())
            if k < len(begins) and begins[k] - m.end() < 200 and not code[m.end() : begins[k]].strip() and like_url(u := content[begins[k] + 1 : strings[k][1] - 1]):
                assigned.setdefault(m[1], []).append((m.start(), inside(m.start()), u))
        rows = []
        for m in call_of.finditer(code):
            method = m[1] or next(texts(m.start(), m.end()), "")
            if method.lower() not in ("get", "post", "put", "patch", "delete"):
                continue
            end = closing.get(m.end() - 1, len(code))
            if re.search(r"blob|responseType:", content[m.start() : end]):
                continue
            around = inside(m.start())
            first = re.match(r"\s*([\w$]+)\s*(?:[,)]|$)", code[m.end() : m.end() + 200])
            known = [u for at, scope, u in assigned.get(first[1], ()) if at < m.start() and (scope is None or scope.begin <= m.start() < scope.end)] if first else []
            if u := known[-1] if known else next((u for u in texts(m.end(), end) if like_url(u)), None):
                rows.append((line(m.start()), around.name if around else "unknown", method.upper(), u))
        return rows

    found = by_file(files, find, "line long, function string, method string, url string")
    return found.withColumn("url", normal_url("url", bases)).where(F.length("url") > 3).dropDuplicates(["path", "line", "method", "url"])


class PrefixRule(NamedTuple):
    """Adds prefix to the routes of files that fit. kind: any, folder, stem, stem_contains or path_contains.

    Of rules with one group only the first that fits counts. once: not where the prefix so far holds it already. replaces:
    instead of what came before.
    """

    kind: str
    pattern: str
    prefix: str
    group: str = ""
    once: bool = False
    replaces: bool = False


def path_prefix(path: str, rules: Sequence[PrefixRule | tuple[str, str]]) -> Column:
    """What rules make of a file's path, one after the other; (part, prefix) is a rule on a part of the path, of which the first that fits counts."""
    rules = [r if isinstance(r, PrefixRule) else PrefixRule("path_contains", *r, group="path") for r in rules]
    names = F.split(F.col(path), "/")
    stem = F.regexp_replace(F.element_at(names, -1), r"\.[^.]*$", "")
    fits = {
        "any": lambda p: F.lit(True), "folder": lambda p: F.array_contains(F.slice(names, F.lit(1), F.size(names) - 1), p), "stem": lambda p: stem == p,
        "stem_contains": lambda p: stem.contains(p), "path_contains": lambda p: F.col(path).contains(p),
    }
    text, done = F.lit(""), set()
    for r in rules:
        if r.group in done:
            continue
        of = [x for x in rules if x.group == r.group] if r.group else [r]
        done |= {r.group} - {""}
        added = F.coalesce(*(F.when(fits[x.kind](x.pattern), F.lit(x.prefix)) for x in of))
        if r.replaces:
            text = F.coalesce(added, text)
        else:
            text = F.concat(text, F.coalesce(F.when(~text.contains(r.prefix), added) if r.once else added, F.lit("")))
    return text


def backend_routes(files: DataFrame, prefixes: Sequence[PrefixRule | tuple[str, str]] = (), routers: DataFrame | None = None) -> DataFrame:
    """path, line, function, method, route and response_model of decorated routes.

    prefixes: rules on paths (path_prefix). routers: path, router and prefix (of python_code.router_prefixes), which
    stand after the path's prefix; a router that is included twice has its routes twice.
    """
    def find(content: str) -> list[tuple]:
        rows = []
        for f in (n for n in ast.walk(parsed(content) or ast.Module([], [])) if isinstance(n, ast.FunctionDef | ast.AsyncFunctionDef)):
            for d in f.decorator_list:
                if isinstance(d, ast.Call) and isinstance(d.func, ast.Attribute) and d.func.attr in ("get", "post", "put", "patch", "delete") and d.args and isinstance(d.args[0], ast.Constant):
                    model = next((ast.unparse(k.value) for k in d.keywords if k.arg == "response_model"), ast.unparse(f.returns) if f.returns else None)
                    rows.append((f.lineno, f.name, d.func.attr.upper(), str(d.args[0].value), model, ast.unparse(d.func.value)))
        return rows

    found = by_file(files, find, "line long, function string, method string, route string, response_model string, router string")
    if routers is not None:
        found = found.join(routers.withColumnRenamed("prefix", "_of_router"), ["path", "router"], "left").withColumn("route", F.concat(F.coalesce("_of_router", F.lit("")), "route"))
    return found.withColumn("route", F.concat(path_prefix("path", prefixes), "route")).select("path", "line", "function", "method", "route", "response_model")
