"""Analyzers of text over corpora that grow with the driver's tables, as queries.

Each part, customer or supplier has definitions and files of its own, in forms that take turns. The SQL gives the rows
that each form must give, from the same tables: it reads no definition.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.plans.actions import action_mapping
from tracewell.plans.code import backend_routes, code_references, frontend_calls, known_tables, model_fields, nested_fields, orm_classes, orm_columns
from tracewell.plans.lineage import lineage_rules, success_rate, view_lineage
from tracewell.plans.procedures import column_uses, profile, variables
from tracewell.plans.python_code import call_facts, function_uses
from tracewell.plans.queries import table

#: Columns that forms are filled with, as SQL for Spark and DuckDB alike.
PARTS = "SELECT p_partkey AS k, 'S.T' || (p_partkey % 97) AS T, 'S.U' || (p_partkey % 89) AS U, 'C' || p_size AS C, 'D' || (p_partkey % 31) AS D FROM part"
CUSTOMERS = "SELECT c_custkey AS k, 'S.T' || c_nationkey || '_TMP' AS T, 'S.U' || c_custkey AS U, 'C' || (c_custkey % 13) AS C, 'D' || (c_custkey % 17) AS D FROM customer"
SUPPLIERS = "SELECT s_suppkey AS k, 'c_' || s_nationkey AS C FROM supplier"

#: Definitions (what follows the head), and the rows that columns A and B get: column, type, tables, columns, operation.
VIEWS: list[tuple[str | None, list[tuple[str, str, str, str, str]]]] = [
    ("SELECT t.@C@ AS A, t.@D@ AS B FROM @T@ t", [("A", "DIRECT", "@T@", "@C@", ""), ("B", "DIRECT", "@T@", "@D@", "")]),
    ("WITH c AS (SELECT t.@C@, LISTAGG(t.@D@, ',') WITHIN GROUP (ORDER BY t.E) AS L FROM @T@ t GROUP BY t.@C@) SELECT @C@, L FROM c", [("A", "DIRECT", "@T@", "@C@", ""), ("B", "DERIVED", "@T@", "@D@; E", "LISTAGG")]),
    ("WITH c AS (SELECT t.@C@[0].x::string AS p, t.@D@[1] q FROM @T@ t) SELECT p, q FROM c", [("A", "DERIVED", "@T@", "@C@", "CAST"), ("B", "DERIVED", "@T@", "@D@", "BRACKET")]),
    ("SELECT p.k, p.y FROM @T@ PIVOT (SUM(@C@) FOR @D@ IN ('x', 'y')) AS p (k, x, y)", [("A", "DIRECT", "@T@", "K", ""), ("B", "DERIVED", "@T@", "@C@; @D@", "PIVOT")]),
    ("SELECT @C@, @D@ FROM @T@ START WITH @C@ IS NULL CONNECT BY PRIOR @D@ = @C@", [("A", "DIRECT", "@T@", "@C@", ""), ("B", "DIRECT", "@T@", "@D@", "")]),
    ("SELECT t.* EXCLUDE (b), u.* FROM @T@ t JOIN @U@ u ON t.i = u.i", [("A", "DIRECT", "@T@", "A", ""), ("B", "DIRECT", "@U@", "B", "")]),
    ("SELECT @C@, u.@D@ FROM @T@ t JOIN @U@ u ON t.i = u.i", [("A", "DIRECT", "@T@", "@C@", ""), ("B", "DIRECT", "@U@", "@D@", "")]),
    ("SELECT @C@, 1 FROM @T@ UNION ALL SELECT @D@, 2 FROM @U@", [("A", "DERIVED", "@T@; @U@", "@C@; @D@", ""), ("B", "DERIVED", "CALCULATED", "LITERAL", "LITERAL")]),
    ("SELECT t.@C@, ROW_NUMBER() OVER (PARTITION BY t.@C@ ORDER BY t.@D@) FROM @T@ t", [("A", "DIRECT", "@T@", "@C@", ""), ("B", "DERIVED", "@T@", "@C@; @D@", "WINDOW")]),
    ("SELECT t.x, t.y FROM (SELECT t.@C@ AS x, t.@D@ + t.E AS y FROM @U@ t) t", [("A", "DIRECT", "@U@", "@C@", ""), ("B", "DERIVED", "@U@", "@D@; E", "ADD")]),
    ("WITH c AS (SELECT t.@C@ AS a, u.* FROM @T@ t JOIN @U@ u ON t.i = u.i) SELECT * FROM c", [("A", "DIRECT", "@T@", "@C@", ""), ("B", "DIRECT", "@U@", "B", "")]),
    ("SELECT * FROM IDENTIFIER('@T@')", [("A", "DIRECT", "@T@", "A", ""), ("B", "DIRECT", "@T@", "B", "")]),
    ("SELEC @C@ FRM @T@", [("ERROR", "ERROR", "ANALYSIS_ERROR", "ANALYSIS_ERROR", "ERROR")]),
    (None, [("ERROR", "ERROR", "DDL_NOT_FOUND", "DDL_NOT_FOUND", "ERROR")]),
    ("SELECT CASE WHEN t.@C@ > 1 THEN t.@D@ ELSE NULL END, NVL(t.@C@, t.@D@) FROM @T@ t", [("A", "DERIVED", "@T@", "@C@; @D@", "CASE"), ("B", "DERIVED", "@T@", "@C@; @D@", "COALESCE")]),
    ("WITH c1 AS (SELECT @C@ x, @D@ y FROM @T@), c2 AS (SELECT x, y FROM c1), c3 AS (SELECT * FROM c2), c4 (p, q) AS (SELECT y, x FROM c3) SELECT q, p FROM c4", [("A", "DIRECT", "@T@", "@C@", ""), ("B", "DIRECT", "@T@", "@D@", "")]),
    ("WITH v AS (SELECT t.@C@ AS a, MAX(t.@D@) AS b FROM @T@ t), w AS (SELECT u.E AS e FROM @U@ u) SELECT * FROM w", [("A", "DIRECT", "@T@", "@C@", ""), ("B", "DERIVED", "@T@", "@D@", "MAX")]),
    ("SELECT u.k, u.val FROM @T@ UNPIVOT (val FOR name IN (@C@, @D@)) u", [("A", "DIRECT", "@T@", "K", ""), ("B", "DERIVED", "@T@", "@C@; @D@", "UNPIVOT")]),
    ("SELECT (SELECT MAX(u.@D@) FROM @U@ u WHERE u.i = t.i), ((t.@C@)) FROM @T@ t", [("A", "DERIVED", "@U@", "@D@", "SUBQUERY"), ("B", "DIRECT", "@T@", "@C@", "")]),
    ("SELECT f.value:n::VARCHAR, t.@D@ FROM @T@ t, LATERAL FLATTEN(input => t.@C@) f", [("A", "DERIVED", "@T@", "@C@", "CAST"), ("B", "DIRECT", "@T@", "@D@", "")]),
]
#: The same for rules, with the JOIN that comes last preferred: column, table, column, rule.
RULED: list[tuple[str, list[tuple[str, str, str, str]]]] = [
    ("SELECT @C@, j.@D@ FROM @T@ t JOIN S.M m ON t.i = m.i LEFT JOIN @U@ j ON t.i = j.i", [("A", "@U@", "@C@", "last_join"), ("B", "@U@", "@D@", "qualified")]),
    ("WITH c AS (SELECT @C@, x.y FROM @T@ x JOIN @U@ ON x.i = 1) SELECT @C@, y FROM c", [("A", "@U@", "@C@", "last_join"), ("B", "@T@", "Y", "known_column")]),
    ("SELECT @C@, @D@ FROM @T@", [("A", "@T@", "@C@", "only_source"), ("B", "@T@", "@D@", "only_source")]),
    ("WITH v AS (SELECT t.@C@ AS a, t.@D@ AS b FROM @T@ t), w AS (SELECT u.E AS e FROM @U@ u) SELECT * FROM w", [("A", "@T@", "@C@", "cte_vote"), ("B", "@T@", "@D@", "cte_vote")]),
    ("SELECT * FROM @T@", [("A", "@T@", "A", "wildcard"), ("B", "@T@", "B", "wildcard")]),
]
#: Procedures: language, temporary tables, cursors, dynamic SQL; variables; and rows of table, column, uses.
PROCEDURES = [
    (
        "LANGUAGE SQL AS $$ DECLARE tgt VARCHAR; BEGIN tgt := '@T@'; CREATE OR REPLACE TEMP TABLE IDENTIFIER(:tgt) AS SELECT o.@C@ FROM @U@ o WHERE o.@D@ > 3; UPDATE S.X@k@ SET @C@ = 1 WHERE @D@ > 2; EXECUTE IMMEDIATE 'x'; END; $$",
        ("SQL", "['TGT']", "[]::VARCHAR[]", "true"), [("tgt", "@T@")],
        [("@U@", "*", "USES_TABLE"), ("@U@", "@C@", "USED_AS_SELECT"), ("@U@", "@D@", "USED_AS_FILTER"), ("S.X@k@", "*", "USED_AS_UPDATE,USES_TABLE"), ("S.X@k@", "@C@", "USED_AS_UPDATE"), ("S.X@k@", "@D@", "USED_AS_FILTER")],
    ),
    (
        "LANGUAGE PYTHON LANGUAGE SQL LET c CURSOR FOR SELECT @C@ FROM @U@; INSERT INTO @T@ SELECT @C@ FROM @U@ ORDER BY @C@;",
        ("MIXED", "[]::VARCHAR[]", "['c']", "false"), [], [("@U@", "*", "USES_TABLE"), ("@U@", "@C@", "USED_AS_ORDER_BY,USED_AS_SELECT"), ("@T@", "*", "USED_AS_INSERT")],
    ),
    (
        "LANGUAGE SQL AS $$ BEGIN DELETE FROM @T@ WHERE @C@ = 1; SELECT u.@D@ FROM @U@ u JOIN @T@ t ON u.@D@ = t.@C@ GROUP BY u.@D@; END; $$",
        ("SQL", "[]::VARCHAR[]", "[]::VARCHAR[]", "false"), [],
        [("@T@", "*", "USED_AS_DELETE,USES_TABLE"), ("@T@", "@C@", "USED_AS_DELETE,USED_AS_JOIN"), ("@U@", "*", "USES_TABLE"), ("@U@", "@D@", "USED_AS_GROUP_BY,USED_AS_JOIN,USED_AS_SELECT")],
    ),
]
#: Code: folder, file, content.
FILES = [
    ("r@k@", "orm.py", 'from sqlalchemy import Table\nt@k@ = Table("tab_@k@", meta)\nclass M@k@(Base):\n    __tablename__ = "mod_@k@"\n    @C@: int\n    _hidden: int\n    items: list = relationship("Item")\n'),
    ("r@k@/api", "__init__.py", "from r@k@.orm import t@k@ as orders, M@k@\n"),
    ("r@k@", "svc.py", 'from .api import orders, M@k@\nclass Root:\n    def shared(self):\n        q = orders\n        return select(q.c.id)\nclass S(Root):\n    def run(self):\n        return self.inner()\n    def inner(self):\n        return self.shared()\n    def models(self):\n        return session.query(M@k@)\ndef call(db):\n    db.execute("CALL PROC_@k@(1)")\n'),
    ("r@k@", "models.py", "class X@k@Read(BaseModel):\n    id: int\n    items: Optional[List[Y@k@Read]]\nclass Y@k@Read(BaseModel):\n    sku: str\n    parent: X@k@Read\n"),
    ("r@k@", "routes.py", 'from r@k@.svc import S, call\n@router.get("/o@k@/{id}", response_model=X@k@Read)\nasync def get_o(id):\n    call(db)\n    return S().run()\n'),
    ("q@k@", "q.py", 'def load(db):\n    sql = """SELECT o.A1, COUNT(o.A2) FROM S.R@k@ o WHERE o.A2 = 3"""\n    return db.execute(sql)\n'),
    ("q@k@", "run.sh", "first() {\n  echo none\n}\nsync_@k@() {\n  echo r@k@ a1 # }\n}\n"),
    ("w@k@", "a.ts", "class A {\n  // client.get('/no')\n  async load(id) {\n    return client.get(`${BASE}/o@k@/${x.id}?y=1`);\n  }\n}\nclient.post('/post@k@');\n"),
]


def _filled(template: str | None) -> Column:
    if template is None:
        return F.lit(None).cast("string")
    return F.concat(*(F.col(x).cast("string") if n % 2 else F.lit(x) for n, x in enumerate(re.split(r"@(\w)@", template)) if x))


def _sql(template: str) -> str:
    """The same for DuckDB."""
    return " || ".join([x if n % 2 else "'" + x.replace("'", "''") + "'" for n, x in enumerate(re.split(r"@(\w)@", template)) if x] or ["''"])


def _rows(spark: SparkSession, d: str, source: str) -> DataFrame:
    name = source.rpartition(" ")[2]
    columns = source.removeprefix("SELECT ").rpartition(" FROM ")[0]
    return table(spark, d, name).selectExpr(*re.split(r", (?=[^()]*(?:\(|$))", columns))


def _forms(rows: DataFrame, templates: list[str | None]) -> Column:
    """The template whose turn it is, filled."""
    turn = F.col("k") % len(templates)
    chosen = F.when(turn == 0, _filled(templates[0]))
    for n, t in enumerate(templates[1:], 1):
        chosen = chosen.when(turn == n, _filled(t))
    return chosen


def _expected(source: str, forms: int, rows: list[tuple[int | None, dict[str, str]]]) -> str:
    """SQL of rows (form, or None for every form; expressions by column)."""
    selects = (f"SELECT {', '.join(f'{e} AS "{c}"' for c, e in columns.items())} FROM rows{'' if n is None else f' WHERE k % {forms} = {n}'}" for n, columns in rows)
    return f"WITH rows AS ({source})\n" + "\nUNION ALL ".join(selects)


def _views(spark: SparkSession, d: str, forms: list[str | None]) -> DataFrame:
    rows = _rows(spark, d, PARTS)
    return rows.select(F.concat(F.lit("V"), F.col("k")).alias("view_name"), F.concat(F.lit("CREATE VIEW V"), F.col("k"), F.lit(" (A, B) AS "), _forms(rows, forms)).alias("ddl"))


def _procedures(spark: SparkSession, d: str) -> DataFrame:
    rows = _rows(spark, d, CUSTOMERS)
    return rows.select(F.concat(F.lit("p"), F.col("k")).alias("procedure_name"), _forms(rows, [p[0] for p in PROCEDURES]).alias("procedure_definition"), F.lit("API").alias("procedure_schema"))


def _files(spark: SparkSession, d: str) -> DataFrame:
    each = F.array(*(F.struct(_filled(folder).alias("folder"), F.lit(name).alias("file_name"), _filled(content).alias("content")) for folder, name, content in FILES))
    rows = _rows(spark, d, SUPPLIERS).select(F.explode(each).alias("f")).select("f.*")
    return rows.select(F.concat_ws("/", "folder", "file_name").alias("path"), F.split_part("folder", F.lit("/"), F.lit(1)).alias("repo_name"), "file_name", F.element_at(F.split("file_name", r"\."), -1).alias("extension"), "content")


def _of(spark: SparkSession, d: str, *names: str) -> DataFrame:
    return _files(spark, d).where(F.col("file_name").isin(*names))


def view_lineage_cases(spark: SparkSession, d: str) -> DataFrame:
    """LIN-01 to LIN-29 over a definition of each part."""
    return view_lineage(spark, _views(spark, d, [v for v, _ in VIEWS]))


def view_success_cases(spark: SparkSession, d: str) -> DataFrame:
    return success_rate(view_lineage_cases(spark, d))


def lineage_rule_cases(spark: SparkSession, d: str) -> DataFrame:
    """LIN-16, 17, 20 to 23: the rule behind each edge, with the last JOIN preferred."""
    return lineage_rules(spark, _views(spark, d, [v for v, _ in RULED]), fallback="last_join")


def procedure_profile_cases(spark: SparkSession, d: str) -> DataFrame:
    return profile(_procedures(spark, d))


def procedure_variable_cases(spark: SparkSession, d: str) -> DataFrame:
    return variables(_procedures(spark, d))


def procedure_column_cases(spark: SparkSession, d: str) -> DataFrame:
    return column_uses(_procedures(spark, d))


def code_reference_cases(spark: SparkSession, d: str) -> DataFrame:
    catalog = _rows(spark, d, SUPPLIERS).select(F.concat(F.lit("R"), F.col("k")).alias("table_name"), F.explode(F.array(F.lit("A1"), F.lit("A2"))).alias("column_name"))
    return code_references(_of(spark, d, "q.py", "run.sh"), catalog)


def orm_column_cases(spark: SparkSession, d: str) -> DataFrame:
    return orm_columns(_of(spark, d, "orm.py", "svc.py", "routes.py"))


def nested_field_cases(spark: SparkSession, d: str) -> DataFrame:
    return nested_fields(model_fields(_of(spark, d, "models.py")))


def _backend(spark: SparkSession, d: str) -> DataFrame:
    return _of(spark, d, "orm.py", "__init__.py", "svc.py", "routes.py", "models.py")


def function_use_cases(spark: SparkSession, d: str) -> DataFrame:
    files = _backend(spark, d)
    return function_uses(call_facts(files), known_tables(files), orm_classes(files))


def frontend_call_cases(spark: SparkSession, d: str) -> DataFrame:
    return frontend_calls(_of(spark, d, "a.ts"), bases={"BASE": "/base"})


def backend_route_cases(spark: SparkSession, d: str) -> DataFrame:
    return backend_routes(_backend(spark, d), [("routes", "/base")])


def action_mapping_cases(spark: SparkSession, d: str) -> DataFrame:
    """REL-01's source: what each front-end call reaches."""
    return action_mapping(_of(spark, d, "a.ts"), _backend(spark, d), [("routes", "/base")], {"BASE": "/base"})


QUERIES = {
    f.__name__: f
    for f in (
        view_lineage_cases, view_success_cases, lineage_rule_cases, procedure_profile_cases, procedure_variable_cases, procedure_column_cases, code_reference_cases,
        orm_column_cases, nested_field_cases, function_use_cases, frontend_call_cases, backend_route_cases, action_mapping_cases,
    )
}


def _columns(names: str, *values: str) -> dict[str, str]:
    return dict(zip(names.split(), map(_sql, values), strict=True))


_VIEW = "view_name view_column column_type source_table source_column expression_type"
_LINEAGE = _expected(PARTS, len(VIEWS), [(n, _columns(_VIEW, "V@k@", *row)) for n, (_, rows) in enumerate(VIEWS) for row in rows])
_USES = [*(("r@k@/svc.py", f, "table", "TAB_@k@") for f in ("Root.shared", "S.inner", "S.run")), ("r@k@/routes.py", "get_o", "table", "TAB_@k@"), ("r@k@/svc.py", "S.models", "table", "MOD_@k@"), ("r@k@/svc.py", "call", "procedure", "PROC_@k@"), ("r@k@/routes.py", "get_o", "procedure", "PROC_@k@")]
SQL = {
    "view_lineage_cases": _LINEAGE,
    "view_success_cases": f"SELECT count(*) AS n_rows, count(DISTINCT view_name) AS n_views, 100 * avg(CASE WHEN column_type IN ('ERROR', 'UNKNOWN') THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END) AS success_percent FROM ({_LINEAGE})",
    "lineage_rule_cases": _expected(PARTS, len(RULED), [(n, _columns("view_name view_column source_table source_column rule", "V@k@", *row)) for n, (_, rows) in enumerate(RULED) for row in rows]),
    "procedure_profile_cases": _expected(CUSTOMERS, len(PROCEDURES), [(n, _columns("procedure_name procedure_schema language", "p@k@", "API", p[1][0]) | dict(zip(("temp_tables", "cursors", "dynamic_sql"), p[1][1:], strict=True))) for n, p in enumerate(PROCEDURES)]),
    "procedure_variable_cases": _expected(CUSTOMERS, len(PROCEDURES), [(n, _columns("procedure_name variable value", "p@k@", *v)) for n, p in enumerate(PROCEDURES) for v in p[2]]),
    "procedure_column_cases": _expected(CUSTOMERS, len(PROCEDURES), [(n, _columns("sp_name sp_schema sp_language table_name column_name relationship_types", "P@k@", "API", p[1][0], *row)) for n, p in enumerate(PROCEDURES) for row in p[3]]),
    "code_reference_cases": _expected(SUPPLIERS, 1, [(None, _columns("repo_name function_name table_name column_name file_name", "q@k@", *row)) for row in (("load", "R@k@", "A1", "q.py"), ("load", "R@k@", "A2", "q.py"), ("sync_@k@", "R@k@", "A1", "run.sh"))]),
    "orm_column_cases": _expected(SUPPLIERS, 1, [(None, _columns("path table_name", "r@k@/orm.py", "MOD_@k@") | {"column_name": "upper(C)"})]),
    "nested_field_cases": _expected(SUPPLIERS, 1, [(None, _columns("model dotted", *row)) for row in (("X@k@Read", "id"), ("X@k@Read", "items"), ("X@k@Read", "items.sku"), ("X@k@Read", "items.parent"), ("Y@k@Read", "sku"), ("Y@k@Read", "parent"), ("Y@k@Read", "parent.id"), ("Y@k@Read", "parent.items"))]),
    "function_use_cases": _expected(SUPPLIERS, 1, [(None, _columns("path function kind name", *row)) for row in _USES]),
    "frontend_call_cases": _expected(SUPPLIERS, 1, [(None, _columns("path function method url", "w@k@/a.ts", *row) | {"line": line}) for line, row in (("4::BIGINT", ("load", "GET", "/base/o@k@/{id}")), ("7::BIGINT", ("unknown", "POST", "/post@k@")))]),
    "backend_route_cases": _expected(SUPPLIERS, 1, [(None, _columns("path function method route response_model", "r@k@/routes.py", "get_o", "GET", "/base/o@k@/{id}", "X@k@Read") | {"line": "3::BIGINT"})]),
    "action_mapping_cases": _expected(SUPPLIERS, 1, [(None, _columns("frontend_file frontend_function http_method frontend_url backend_file backend_function backend_route database_tables stored_procedures flow_calls response_model response_fields nested_fields table_column_details", *row)) for row in (
        ("a.ts", "load", "GET", "/base/o@k@/{id}", "routes.py", "get_o", "/base/o@k@/{id}", "TAB_@k@", "PROC_@k@", "", "X@k@Read", "id,items", "items.parent,items.sku", "TAB_@k@:[unknown]"), ("a.ts", "unknown", "POST", "/post@k@", *[""] * 10))]),
}
