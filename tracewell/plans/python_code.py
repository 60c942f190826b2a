"""What Python functions use: tables, procedures and flows, of their own and of all that they call.

One walk over a file's syntax tree, in the task that has the file, gives flat facts: definitions, imports, calls, what
variables are given, and the names and texts that each function mentions. All else is joins: imports to files and through
re-exports to definitions, receivers of calls to classes and along their bases to methods, variables to what they were
given, step by step until nothing new is found.
"""

from __future__ import annotations

import ast
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.operators.closure import ROUNDS, reachable
from tracewell.plans.code import SKIPPED_CALLS, by_file, parsed, sql_tables
from tracewell.storage import stored

FACTS = "function string, owner string, kind string, name string, value string"
#: Kinds of facts. A function is named with the classes and functions around it (Orders.load); module level is the empty name.
#: def, class, base, import: what a scope defines. new, alias, text, table: what a name is given (an object of a class,
#: another name, a text, a declared table). call, name, string, procedure, flow: what a scope mentions. router, include:
#: routers with their prefix, and what they include under which prefix.
GIVEN = ("new", "alias", "text", "table")
#: Classes of routers and the methods that include one in another.
ROUTERS = ("APIRouter", "FastAPI", "Blueprint", "Flask")
INCLUDES = ("include_router", "register_blueprint")


def text_of(call: ast.Call, argument: str) -> str:
    return next((k.value.value for k in call.keywords if k.arg == argument and isinstance(k.value, ast.Constant) and isinstance(k.value.value, str)), "")


def dotted(n: ast.AST | None) -> str | None:
    """`a.b`, `a().b` and the like as text."""
    if isinstance(n, ast.Name):
        return n.id
    if isinstance(n, ast.Attribute):
        inner = dotted(n.value)
        return f"{inner}.{n.attr}" if inner else None
    if isinstance(n, ast.Call):
        inner = dotted(n.func)
        return f"{inner}()" if inner else None
    return None


class Walk(ast.NodeVisitor):
    """Collects the facts of a file."""

    def __init__(self, procedure_class: str = ""):
        self.rows: set[tuple] = set()
        self.function, self.owner, self.flows, self.procedure_class = "", "", frozenset(), procedure_class

    def add(self, kind: str, name: str, value: str | None = "") -> None:
        self.rows.add((self.function, self.owner, kind, name, value or ""))

    def inside(self, node: ast.AST, function: str, owner: str) -> None:
        before = self.function, self.owner, self.flows
        self.function, self.owner = function, owner
        for child in node.body:
            self.visit(child)
        self.function, self.owner, self.flows = before

    def visit_FunctionDef(self, node: ast.FunctionDef | ast.AsyncFunctionDef) -> None:
        full = ".".join(filter(None, [self.function or self.owner, node.name]))
        self.add("def", node.name, full)
        for part in [*node.decorator_list, node.args, *filter(None, [node.returns])]:
            self.visit(part)
        before, self.function = self.function, full
        for a in (*node.args.posonlyargs, *node.args.args, *node.args.kwonlyargs):
            if kind := dotted(a.annotation):
                self.add("new", a.arg, kind)
        self.function = before
        self.inside(node, full, self.owner)

    visit_AsyncFunctionDef = visit_FunctionDef

    def visit_ClassDef(self, node: ast.ClassDef) -> None:
        full = ".".join(filter(None, [self.function or self.owner, node.name]))
        self.add("class", node.name, full)
        for base in node.bases:
            if name := dotted(base):
                self.rows.add(("", full, "base", name, ""))
        self.inside(node, "", full)

    def visit_Import(self, node: ast.Import) -> None:
        for a in node.names:
            self.add("import", a.asname or a.name, f"0|{a.name}|")

    def visit_ImportFrom(self, node: ast.ImportFrom) -> None:
        for a in node.names:
            self.add("import", a.asname or a.name, f"{node.level}|{node.module or ''}|{a.name}")

    def given(self, target: str, value: ast.AST | None) -> None:
        """target is given value; choices between values give each."""
        if isinstance(value, ast.IfExp):
            self.given(target, value.body), self.given(target, value.orelse)
        elif isinstance(value, ast.BoolOp):
            for v in value.values:
                self.given(target, v)
        elif isinstance(value, ast.Dict):  # names looked up by key
            for v in value.values:
                self.given(target, v)
        elif isinstance(value, ast.Subscript):
            self.given(target, value.value)
        elif isinstance(value, ast.Await):
            self.given(target, value.value)
        elif isinstance(value, ast.Constant) and isinstance(value.value, str):
            self.add("text", target, value.value)
        elif isinstance(value, ast.Call) and (made := dotted(value.func)):
            first = value.args[0] if value.args else None
            if made.rpartition(".")[2] in ROUTERS:
                self.add("router", target, text_of(value, "prefix") or text_of(value, "url_prefix"))
            if made.rpartition(".")[2] == "Table" and isinstance(first, ast.Constant) and isinstance(first.value, str):
                self.add("table", target, first.value)
            else:
                self.add("new", target, made)
                if made.endswith((".get", ".alias", ".subquery")):  # of what it is called on
                    self.add("alias", target, made.rpartition(".")[0])
        elif name := dotted(value):
            self.add("alias", target, name)

    def assign(self, targets: list[ast.AST], value: ast.AST | None) -> None:
        for t in targets:
            if isinstance(t, ast.Tuple) and isinstance(value, ast.Tuple) and len(t.elts) == len(value.elts):
                for a, b in zip(t.elts, value.elts, strict=True):
                    self.assign([a], b)
            elif name := dotted(t):
                self.given(name, value)

    def visit_Assign(self, node: ast.Assign) -> None:
        self.assign(node.targets, node.value)
        self.generic_visit(node)

    def visit_AnnAssign(self, node: ast.AnnAssign) -> None:
        self.assign([node.target], node.value)
        if (name := dotted(node.target)) and (kind := dotted(node.annotation)):
            self.add("new", name, kind)
        self.generic_visit(node)

    def visit_NamedExpr(self, node: ast.NamedExpr) -> None:
        self.assign([node.target], node.value)
        self.generic_visit(node)

    def visit_With(self, node: ast.With | ast.AsyncWith) -> None:
        for i in node.items:
            if isinstance(i.optional_vars, ast.Name):
                self.given(i.optional_vars.id, i.context_expr)
                if isinstance(i.context_expr, ast.Call) and "flow" in (dotted(i.context_expr.func) or "").rpartition(".")[2].lower():
                    self.flows |= {i.optional_vars.id}
        self.generic_visit(node)

    visit_AsyncWith = visit_With

    def visit_Call(self, node: ast.Call) -> None:
        name = dotted(node.func)
        if name and name not in SKIPPED_CALLS:
            self.add("call", name)
        if isinstance(node.func, ast.Attribute) and node.func.attr in INCLUDES and node.args and (child := dotted(node.args[0])):
            self.add("include", dotted(node.func.value) or "", f"{child}|{text_of(node, 'prefix') or text_of(node, 'url_prefix')}")
        if isinstance(node.func, ast.Attribute):
            owner = (dotted(node.func.value) or "").rpartition(".")[2]
            if owner in self.flows or "flow_service" in owner:
                self.add("flow", node.func.attr)
            if node.func.attr == "add_task" and node.args and (task := dotted(node.args[0])):
                self.add("call", task)
        for k in node.keywords:
            if k.arg == "proc_name" and (p := k.value.value if isinstance(k.value, ast.Constant) else (dotted(k.value) or "").rpartition(".")[2]):
                self.add("procedure", str(p).upper())
        self.generic_visit(node)

    def visit_Attribute(self, node: ast.Attribute) -> None:
        name = dotted(node)
        if name:
            self.add("name", name)
            if self.procedure_class and name.rpartition(".")[0].rpartition(".")[2] == self.procedure_class:
                self.add("procedure", node.attr.upper())
        self.generic_visit(node)

    def visit_Name(self, node: ast.Name) -> None:
        if isinstance(node.ctx, ast.Load):
            self.add("name", node.id)

    def visit_Constant(self, node: ast.Constant) -> None:
        if isinstance(node.value, str):
            self.add("string", node.value)


def call_facts(files: DataFrame, procedure_class: str = "") -> DataFrame:
    """path, function, owner (the class around it), kind, name and value of the facts of Python files. procedure_class: the name of a class whose attributes are procedures."""
    def find(content: str) -> list[tuple]:
        tree = parsed(content)
        walk = Walk(procedure_class)
        if tree is not None:
            try:
                walk.visit(tree)
            except RecursionError:  # a tree deeper than Python's recursion adds what was found before
                pass
        return sorted(walk.rows)

    return by_file(files, find, FACTS)


def _module(path: str | Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, r"(^|/)(?:__init__)?\.py$|\.py$", ""), "/", ".")


def _suffixes(module: Column) -> Column:
    parts = F.split(module, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def imports(facts: DataFrame) -> DataFrame:
    """path, name and what it is bound to by an import of a file that is here: d_path and d_name (empty: the file itself).

    A module that several files could be is the one whose path has the longest part in common with the importing file's.
    """
    files = facts.select("path").distinct()
    by_suffix = files.select(F.col("path").alias("d_path"), F.explode(_suffixes(_module("path"))).alias("module"), _module("path").alias("exact"))
    part = F.split("value", r"\|")
    level = part[0].cast("int")
    folder = F.slice(F.split("path", "/"), F.lit(1), F.greatest(F.size(F.split("path", "/")) - F.greatest(level, F.lit(1)), F.lit(0)))
    absolute = F.when(level == 0, part[1]).otherwise(F.array_join(F.concat(folder, F.filter(F.array(part[1]), lambda x: x != "")), "."))
    named = facts.where("kind = 'import'").select("path", "name", (level > 0).alias("relative"), absolute.alias("module"), part[2].alias("original")).distinct()
    inner = F.concat_ws(".", F.when(F.col("module") != "", F.col("module")), "original")
    asked = named.select("*", F.explode(F.array(F.struct(F.col("module").alias("asked"), F.col("original").alias("d_name")), F.struct(F.when(~F.col("original").isin("", "*"), inner).alias("asked"), F.lit("").alias("d_name")))).alias("x"))
    asked = asked.select("path", "name", "relative", "x.*").where("asked is not null")
    hit = asked.join(by_suffix, asked["asked"] == by_suffix["module"]).where((~F.col("relative") | (F.col("exact") == F.col("asked"))) & (F.col("path") != F.col("d_path")))
    ours, theirs = F.split("path", "/"), F.split("d_path", "/")
    common = F.aggregate(F.sequence(F.lit(0), F.size(ours) - 1), F.lit(0), lambda n, i: F.when((n == i) & (F.get(ours, i) == F.get(theirs, i)), n + 1).otherwise(n))
    return hit.groupBy("path", "name", "d_name").agg(F.min_by("d_path", F.struct(-common, F.length("d_path"), "d_path")).alias("d_path"))


def bindings(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names of modules: path, name and the definition (d_path, d_name) behind it, through imports and re-exports; and names that are modules: path, name, d_path.

    A star passes what its module defines or imports by name.
    """
    own = facts.where("function = '' and owner = '' and kind in ('def', 'class', 'new', 'alias', 'text', 'table')").select("path", "name").distinct()
    bound = stored(imports(facts), "imports")
    visible = own.unionByName(bound.where("name != '*'").select("path", "name")).distinct()
    starred = bound.where("name = '*'").select("path", F.col("d_path").alias("_from")).join(visible.select(F.col("path").alias("_from"), "name"), "_from").select("path", "name", F.col("_from").alias("d_path"), F.col("name").alias("d_name"))
    links = stored(bound.where("name != '*' and d_name != ''").select("path", "name", "d_path", "d_name").unionByName(starred.join(own, ["path", "name"], "left_anti")).distinct(), "links")
    found = own.select("path", "name", F.col("path").alias("d_path"), F.col("name").alias("d_name"))
    onward = links.select(F.col("path").alias("d_path"), F.col("name").alias("d_name"), F.col("d_path").alias("_p"), F.col("d_name").alias("_n"))
    defined = own.select(F.col("path").alias("d_path"), F.col("name").alias("d_name"))
    frontier = seen = links
    for n in count(1):
        found = found.unionByName(frontier.join(defined, ["d_path", "d_name"], "left_semi").select("path", "name", "d_path", "d_name"))
        step = frontier.join(onward, ["d_path", "d_name"]).select("path", "name", F.col("_p").alias("d_path"), F.col("_n").alias("d_name")).distinct()
        frontier = stored(step.join(seen, ["path", "name", "d_path", "d_name"], "left_anti"), "re-exports")
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
        if n % ROUNDS == 0:
            found, seen = stored(found, "bindings"), stored(seen, "re-exports")
    modules = bound.where("d_name = ''").select("path", "name", "d_path")
    return stored(found.distinct(), "bindings"), stored(modules.distinct(), "modules")


def lookup(refs: DataFrame, names: DataFrame, modules: DataFrame) -> DataFrame:
    """refs (path, name, ...) with the definitions (d_path, d_name) that a name, or a dotted name through a module, stands for."""
    rest = [c for c in refs.columns]
    plain = refs.join(names, ["path", "name"]).select(*rest, "d_path", "d_name")
    split = refs.where(F.col("name").contains(".")).withColumns({"_head": F.regexp_extract("name", r"^(.*)\.[^.]+$", 1), "_tail": F.regexp_extract("name", r"([^.]+)$", 1)})
    inside = split.join(modules.select("path", F.col("name").alias("_head"), F.col("d_path").alias("_file")), ["path", "_head"])
    through = inside.join(names.select(F.col("path").alias("_file"), F.col("name").alias("_tail"), "d_path", "d_name"), ["_file", "_tail"]).select(*rest, "d_path", "d_name")
    return plain.unionByName(through)


def method_order(facts: DataFrame, names: DataFrame, modules: DataFrame) -> DataFrame:
    """path and class, and every class that it inherits from (d_path, d_class), with the number of steps: 0 is the class itself."""
    classes = facts.where("kind = 'class'").select("path", F.col("value").alias("class")).distinct()
    bases = lookup(facts.where("kind = 'base'").select("path", F.col("owner").alias("class"), "name").distinct(), names, modules)
    edges = bases.select(F.struct("path", "class").alias("a"), F.struct(F.col("d_path").alias("path"), F.col("d_name").alias("class")).alias("b")).distinct()
    above = reachable(edges, "a", "b", depth=50).select("source.*", F.col("target.path").alias("d_path"), F.col("target.class").alias("d_class"), "steps")
    return classes.select("path", "class", F.col("path").alias("d_path"), F.col("class").alias("d_class"), F.lit(0).alias("steps")).unionByName(above)


def call_edges(facts: DataFrame, names: DataFrame, modules: DataFrame) -> DataFrame:
    """caller and callee as structs (path, function): calls of functions, constructors and methods whose receiver's class is known.

    Known are self, cls and super(), objects made in the call, in the function, in the class (self.x) or at module level,
    annotated parameters, and classes themselves. Calls of anything else are no edges.
    """
    at = ["path", "function"]
    calls = facts.where("kind = 'call'").select(*at, "owner", "name").distinct()
    defs = facts.where("kind = 'def'").select("path", F.col("value").alias("function"), "name", F.col("function").alias("around")).distinct()
    nested = defs.where("around != ''").select("path", F.col("around").alias("function"), "name", F.col("function").alias("inner"))
    # plain names and names in modules
    local = calls.join(nested, [*at, "name"]).select(*at, F.col("path").alias("d_path"), F.col("inner").alias("d_name"))
    of_names = lookup(calls.join(nested, [*at, "name"], "left_anti").select(*at, "name"), names, modules).select(*at, "d_path", "d_name")
    functions = local.unionByName(of_names).join(defs.select(F.col("path").alias("d_path"), F.col("function").alias("d_name")), ["d_path", "d_name"], "left_semi")

    # receivers and their classes
    received = calls.where(F.col("name").contains(".")).select(*at, "owner", F.regexp_extract("name", r"^(.*)\.[^.]+$", 1).alias("receiver"), F.regexp_extract("name", r"([^.]+)$", 1).alias("method"))
    as_class = lambda rows: lookup(rows.select(*at, "method", "path", F.col("class_name").alias("name")).select(*at, "method", "name"), names, modules).select(*at, "method", "d_path", F.col("d_name").alias("d_class"), F.lit(0).alias("least"))
    own = received.where("receiver in ('self', 'cls', 'super()') and owner != ''").select(*at, "method", F.col("path").alias("d_path"), F.col("owner").alias("d_class"), F.when(F.col("receiver") == "super()", 1).otherwise(0).alias("least"))
    made = as_class(received.where("receiver like '%()'").select(*at, "method", F.expr("substring(receiver, 1, length(receiver) - 2)").alias("class_name")))
    named = as_class(received.select(*at, "method", F.col("receiver").alias("class_name")))
    given = facts.where("kind = 'new'").select("path", "function", "owner", F.col("name").alias("receiver"), F.col("value").alias("class_name")).distinct()
    variables = as_class(received.join(given.where("receiver not like 'self.%'").drop("owner"), [*at, "receiver"]))
    fields = as_class(received.join(given.where("receiver like 'self.%'").drop("function").distinct(), ["path", "owner", "receiver"]))
    # objects at module level, here or imported: their class is known where they were made
    objects = lookup(received.select(*at, "method", F.col("receiver").alias("name")), names, modules)
    objects = objects.join(given.where("function = '' and owner = ''").select(F.col("path").alias("d_path"), F.col("receiver").alias("d_name"), "class_name"), ["d_path", "d_name"])
    objects = lookup(objects.select(F.col("path").alias("_path"), "function", "method", F.col("d_path").alias("path"), F.col("class_name").alias("name")), names, modules).select(F.col("_path").alias("path"), "function", "method", "d_path", F.col("d_name").alias("d_class"), F.lit(0).alias("least"))
    constructed = of_names.select(*at, F.lit("__init__").alias("method"), "d_path", F.col("d_name").alias("d_class"), F.lit(0).alias("least"))
    on = own.unionByName(made).unionByName(named).unionByName(variables).unionByName(fields).unionByName(objects).unionByName(constructed).distinct()

    # the method of the nearest class that has it
    order = stored(method_order(facts, names, modules), "method-order").select(F.col("path").alias("d_path"), F.col("class").alias("d_class"), F.col("d_path").alias("m_path"), F.col("d_class").alias("m_class"), "steps")
    methods = facts.where("kind = 'def' and owner != '' and function = ''").select(F.col("path").alias("m_path"), F.col("owner").alias("m_class"), F.col("name").alias("method"), F.col("value").alias("target")).distinct()
    hits = on.join(order, ["d_path", "d_class"]).where("steps >= least").join(methods, ["m_path", "m_class", "method"])
    nearest = hits.groupBy(*at, "method", "d_path", "d_class").agg(F.min_by(F.struct("m_path", "target"), F.struct("steps", "m_path", "m_class")).alias("m")).select(*at, F.col("m.m_path").alias("d_path"), F.col("m.target").alias("d_name"))

    inner = nested.select(*at, F.col("path").alias("d_path"), F.col("inner").alias("d_name"))  # what is defined inside counts as called
    every = functions.select(*at, "d_path", "d_name").unionByName(nearest).unionByName(inner).distinct()
    return every.select(F.struct(*at).alias("caller"), F.struct(F.col("d_path").alias("path"), F.col("d_name").alias("function")).alias("callee"))


def named_values(facts: DataFrame, names: DataFrame, modules: DataFrame) -> DataFrame:
    """path, function, kind (table, text or class) and value that names mentioned in a function stand for, however often they are handed on."""
    at = ["path", "function"]
    given = facts.where(F.col("kind").isin(*GIVEN)).select(*at, "kind", "name", "value").distinct()
    local = given.select(*at, "name").distinct().withColumn("is_local", F.lit(True))
    places = facts.where("kind = 'name'").select(*at, "name").distinct()
    # t.c.x, t.x and t are mentions of t; a.b may also be t in the module a, and a field of the class
    heads = F.transform(F.sequence(F.lit(1), F.size(F.split("name", r"\."))), lambda i: F.array_join(F.slice(F.split("name", r"\."), F.lit(1), i), "."))
    mentions = places.select(*at, F.explode(heads).alias("name")).distinct()
    frontier = stored(mentions.select(*at, F.col("path").alias("v_path"), F.col("function").alias("v_function"), F.col("name").alias("v_name")), "values-frontier")
    seen, found = frontier, None
    here = ["v_path", "v_function", "v_name"]
    facts_at = given.select(F.col("path").alias("v_path"), F.col("function").alias("v_function"), F.col("name").alias("v_name"), "kind", "value")
    for n in count(1):
        hit = frontier.join(facts_at, here)
        ends = stored(hit.where("kind in ('table', 'text')").select(*at, "kind", "value").distinct(), "values")
        found = ends if found is None else found.unionByName(ends)
        handed = hit.where("kind = 'alias'").select(*at, "v_path", "v_function", F.col("value").alias("v_name"))
        outward = frontier.join(local.select(F.col("path").alias("v_path"), F.col("function").alias("v_function"), F.col("name").alias("v_name"), "is_local"), here, "left").where("is_local is null and v_function != ''").select(*at, "v_path", F.lit("").alias("v_function"), "v_name")
        at_module = frontier.where("v_function = ''").select(*at, F.col("v_path").alias("_p"), F.col("v_name").alias("name"))
        imported = lookup(at_module.select(F.col("path").alias("_path"), "function", F.col("_p").alias("path"), "name"), names, modules).where("d_path != path or d_name != name")
        imported = imported.select(F.col("_path").alias("path"), "function", F.col("d_path").alias("v_path"), F.lit("").alias("v_function"), F.col("d_name").alias("v_name"))
        step = handed.unionByName(outward).unionByName(imported).distinct()
        frontier = stored(step.join(seen, [*at, *here], "left_anti"), "values-frontier")
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
        if n % ROUNDS == 0:
            found, seen = stored(found.distinct(), "values"), stored(seen, "values-seen")
    return found.distinct()


CALLED = r"(?i)\bCALL\s+(?:IDENTIFIER\s*\(\s*')?([\w.]+)|\bCREATE\s+(?:OR\s+REPLACE\s+)?PROCEDURE\s+([\w.]+)"


def function_uses(facts: DataFrame, tables: DataFrame, models: DataFrame | None = None, depth: int = 5, procedures: DataFrame | None = None) -> DataFrame:
    """path, function, kind (table, procedure, flow) and name, of a function itself and of all that it calls in up to `depth` steps.

    tables: known table_names. models: class and table_name of mapped classes, which a function uses when it mentions them.
    procedures: function and name, for calls that run procedures under another name.
    """
    facts = stored(facts, "facts")
    names, modules = bindings(facts)
    at = ["path", "function"]
    known = tables.select(F.upper("table_name").alias("name")).distinct()
    mine = facts.where("function != ''")
    strings = mine.where("kind = 'string'").select(*at, "name").distinct()
    values = stored(named_values(mine.unionByName(facts.where("function = '' and owner = ''")), names, modules), "values").where("function != ''")
    strings = strings.unionByName(values.where("kind = 'text'").select(*at, F.col("value").alias("name"))).distinct()
    in_sql = strings.where("length(name) > 20").select(*at, F.explode(sql_tables("name")).alias("name")).select(*at, F.upper("name").alias("name")).join(known, "name", "left_semi")
    plain = strings.select(*at, F.upper("name").alias("name")).join(known, "name", "left_semi")
    used = in_sql.unionByName(plain).unionByName(values.where("kind = 'table'").select(*at, F.upper("value").alias("name")))
    if models is not None:
        mapped = models.select(F.col("class").alias("name"), F.upper("table_name").alias("mapped"))
        mentioned = mine.where("kind in ('name', 'call')").select(*at, F.explode(F.split(F.regexp_replace("name", r"\(\)", ""), r"\.")).alias("name")).distinct()
        used = used.unionByName(mentioned.join(mapped, "name").select(*at, F.col("mapped").alias("name")))
    called = strings.select(*at, F.upper(F.concat(F.regexp_extract("name", CALLED, 1), F.regexp_extract("name", CALLED, 2))).alias("name")).where("name != ''")
    kinds = used.withColumn("kind", F.lit("table")).unionByName(called.withColumn("kind", F.lit("procedure"))).unionByName(mine.where("kind in ('procedure', 'flow')").select(*at, "name", "kind"))
    if procedures is not None:
        mapped = procedures.select(F.col("function").alias("_called"), F.upper("name").alias("procedure"))
        by_call = mine.where("kind = 'call'").select(*at, F.regexp_extract("name", r"([^.]+)$", 1).alias("_called")).distinct()
        kinds = kinds.unionByName(by_call.join(mapped, "_called").select(*at, F.col("procedure").alias("name"), F.lit("procedure").alias("kind")))
        itself = facts.where("kind = 'def'").select("path", F.col("value").alias("function"), F.col("name").alias("_called")).distinct()
        kinds = kinds.unionByName(itself.join(mapped, "_called").select(*at, F.col("procedure").alias("name"), F.lit("procedure").alias("kind")))
    kinds = kinds.select(F.struct(*at).alias("node"), "kind", "name").distinct()
    below = reachable(call_edges(facts, names, modules), "caller", "callee", depth).select(F.col("source").alias("caller"), F.col("target").alias("node"))
    below = below.where("caller.function != ''")
    return kinds.unionByName(below.join(kinds, "node").select(F.col("caller").alias("node"), "kind", "name")).distinct().select("node.*", "kind", "name")


def router_prefixes(facts: DataFrame) -> DataFrame:
    """path, router and each prefix that its routes have: its own, after those of the routers that include it, as far up as these go. A router that includes itself adds nothing more."""
    facts = stored(facts.where("kind in ('router', 'include', 'import', 'def', 'class', 'new', 'alias', 'text', 'table')"), "router-facts")
    names, modules = bindings(facts)
    own = facts.where("kind = 'router'").groupBy("path", "name").agg(F.min("value").alias("prefix"))
    given = facts.where("kind = 'include'").select("path", F.col("name").alias("parent"), F.split_part("value", F.lit("|"), F.lit(1)).alias("name"), F.split_part("value", F.lit("|"), F.lit(2)).alias("under")).distinct()
    children = lookup(given, names, modules).select("path", "parent", "under", "d_path", "d_name")
    parents = lookup(children.select("path", F.col("parent").alias("name"), "under", F.col("d_path").alias("c_path"), F.col("d_name").alias("c_name")), names, modules)
    edges = parents.select(F.struct(F.col("c_path").alias("path"), F.col("c_name").alias("name")).alias("node"), F.struct(F.col("d_path").alias("path"), F.col("d_name").alias("name")).alias("up"), "under").distinct()
    above = own.select(F.struct("path", "name").alias("up"), F.col("prefix").alias("up_prefix"))
    edges = stored(edges.join(above, "up", "left").withColumn("added", F.concat(F.coalesce("up_prefix", F.lit("")), "under")).select("node", "up", "added"), "includes")
    included = edges.select("node").distinct().withColumn("included", F.lit(True))
    frontier = stored(own.select("path", F.col("name").alias("router"), F.struct("path", "name").alias("node"), "prefix", F.array(F.struct("path", "name")).alias("seen")), "routers")
    found = None
    for n in count(1):
        ends = frontier.join(included, "node", "left").where("included is null").select("path", "router", "prefix")
        found = ends if found is None else found.unionByName(ends)
        step = frontier.join(edges, "node").where(~F.array_contains("seen", F.col("up"))).select("path", "router", F.col("up").alias("node"), F.concat("added", "prefix").alias("prefix"), F.concat("seen", F.array("up")).alias("seen"))
        frontier = stored(step.distinct(), "routers")
        if frontier.isEmpty():
            break
        if n % ROUNDS == 0:
            found = stored(found, "router-prefixes")
    return found.distinct()
