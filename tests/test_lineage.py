"""Worked cases of column lineage."""

import pytest

from tracewell.plans.lineage import lineage_rules, resolve, view_lineage

CASES = {
    "G1": ("CREATE VIEW S.V (A, B) AS SELECT t.x AS A, t.y AS B FROM S.T t", [("A", "DIRECT", "S.T", "X", ""), ("B", "DIRECT", "S.T", "Y", "")]),
    "G2": ("CREATE VIEW V (C) AS SELECT a.x + b.y AS C FROM T1 a JOIN T2 b ON a.k=b.k", [("C", "DERIVED", "T1; T2", "X; Y", "ADD")]),
    "G3": ("CREATE VIEW V (X, Y) AS SELECT * FROM S.T", [("X", "DIRECT", "S.T", "X", ""), ("Y", "DIRECT", "S.T", "Y", "")]),
    "G4": ("CREATE VIEW V (A) AS WITH c AS (SELECT t.x AS A FROM S.T t) SELECT c.A AS A FROM c", [("A", "DIRECT", "S.T", "X", "")]),
    "G5": ("CREATE VIEW V (A, B) AS SELECT * FROM IDENTIFIER('S.T')", [("A", "DIRECT", "S.T", "A", ""), ("B", "DIRECT", "S.T", "B", "")]),
    "G6": ("CREATE VIEW V AS SELECT 1 AS A", []),
    "G7": ("DROP VIEW V", [("ERROR", "ERROR", "ANALYSIS_ERROR", "ANALYSIS_ERROR", "ERROR")]),
    "G8": ("CREATE VIEW V (A) AS SELECT 1 + 2 AS A FROM S.T t", [("A", "DERIVED", "CALCULATED", "ADD", "ADD")]),
    "G9": ("CREATE VIEW V (R) AS SELECT ROW_NUMBER() OVER (PARTITION BY t.k ORDER BY t.d) AS R FROM S.T t", [("R", "DERIVED", "S.T", "D; K", "WINDOW")]),
    "G10": ("CREATE VIEW V (X) AS SELECT NVL(t.a, t.b) AS X FROM S.T t", [("X", "DERIVED", "S.T", "A; B", "COALESCE")]),
    "G11": ("CREATE VIEW V (X) AS SELECT a + b AS X FROM S.T", [("X", "DERIVED", "S.T", "A; B", "ADD")]),
    "G12": ("CREATE VIEW V (K, TOT) AS WITH c AS (SELECT t.k AS K, SUM(t.v) AS TOT FROM S.T t GROUP BY t.k) SELECT c.K AS K, c.TOT AS TOT FROM c", [("K", "DIRECT", "S.T", "K", ""), ("TOT", "DERIVED", "S.T", "V", "SUM")]),
    "star through scopes": ("CREATE VIEW V (A, Z) AS WITH c AS (SELECT t.x AS a, u.* FROM S.T t JOIN S.U u ON t.i=u.i) SELECT * FROM c", [("A", "DIRECT", "S.T", "X", ""), ("Z", "DIRECT", "S.U", "Z", "")]),
    "union": ("CREATE VIEW V (A) AS SELECT x FROM T1 UNION ALL SELECT y FROM T2", [("A", "DERIVED", "T1; T2", "X; Y", "")]),
    "scoped aliases": ("CREATE VIEW V (A) AS SELECT t.a FROM (SELECT t.b AS a FROM INNERT t) t", [("A", "DIRECT", "INNERT", "B", "")]),
    "qualify": ("CREATE VIEW V (A) AS SELECT t.a FROM S.T t QUALIFY ROW_NUMBER() OVER (PARTITION BY t.k ORDER BY t.d) = 1", [("A", "DIRECT", "S.T", "A", "")]),
    "scalar subquery": ("CREATE VIEW V (M) AS SELECT (SELECT MAX(u.z) FROM S.U u WHERE u.k = t.k) AS M FROM S.T t", [("M", "DERIVED", "S.U", "Z", "SUBQUERY")]),
    "quoted and cast": ('CREATE OR REPLACE SECURE VIEW "S"."V" ("A b", B) COPY GRANTS COMMENT = \'x (y\' AS SELECT t."q c"::NUMBER(38,0) AS "A b", CAST(t.d AS DATE) B FROM "S"."T" t -- end', [("A B", "DERIVED", "S.T", "Q C", "CAST"), ("B", "DERIVED", "S.T", "D", "CAST")]),
    "case and between": ("CREATE VIEW V (A, B) AS SELECT CASE WHEN t.x BETWEEN 1 AND 2 THEN t.y ELSE NULL END A, t.x || '-' || t.y FROM S.T t WHERE t.k IS NOT NULL", [("A", "DERIVED", "S.T", "X; Y", "CASE"), ("B", "DERIVED", "S.T", "X; Y", "CONCAT")]),
    "columns of a CTE": ("CREATE VIEW V (A) AS WITH c (p, q) AS (SELECT x, y FROM S.T) SELECT q FROM c", [("A", "DIRECT", "S.T", "Y", "")]),
    "flatten": ("CREATE VIEW V (A, B) AS SELECT f.value:name::VARCHAR A, t.id FROM S.T t, LATERAL FLATTEN(input => t.items) f", [("A", "DERIVED", "S.T", "ITEMS", "CAST"), ("B", "DIRECT", "S.T", "ID", "")]),
    "nested joins": ("CREATE VIEW V (A, B) AS SELECT a.x, c.z FROM (A1 a JOIN B1 b ON a.k = b.k) LEFT JOIN C1 c USING (k)", [("A", "DIRECT", "A1", "X", ""), ("B", "DIRECT", "C1", "Z", "")]),
    "table as select": ("CREATE TABLE T2 AS SELECT t.a, COUNT(*) AS n FROM S.T t GROUP BY 1", [("A", "DIRECT", "S.T", "A", ""), ("N", "DERIVED", "CALCULATED", "COUNT", "COUNT")]),
    "within group": ("CREATE VIEW V (K, L) AS SELECT t.k, LISTAGG(t.b, ',') WITHIN GROUP (ORDER BY t.c) AS L FROM S.T t GROUP BY t.k", [("K", "DIRECT", "S.T", "K", ""), ("L", "DERIVED", "S.T", "B; C", "LISTAGG")]),
    "within group in a CTE": ("CREATE VIEW V (K, L) AS WITH c AS (SELECT t.k, LISTAGG(t.b, ',') WITHIN GROUP (ORDER BY t.c) AS L FROM S.T t GROUP BY t.k) SELECT k, L FROM c", [("K", "DIRECT", "S.T", "K", ""), ("L", "DERIVED", "S.T", "B; C", "LISTAGG")]),
    "index paths": ("CREATE VIEW V (A, B, C) AS SELECT t.a[0].b::string, t.a[0] AS x, t.v:p[1].q y FROM S.T t", [("A", "DERIVED", "S.T", "A", "CAST"), ("B", "DERIVED", "S.T", "A", "BRACKET"), ("C", "DERIVED", "S.T", "V", "JSONEXTRACT")]),
    "index paths in a CTE": ("CREATE VIEW V (A) AS WITH c AS (SELECT a[i].b z FROM S.T) SELECT z FROM c", [("A", "DERIVED", "S.T", "A; I", "DOT")]),
    "pivot": ("CREATE VIEW V (K, A, B) AS SELECT p.k, p.c, p.d FROM S.T PIVOT (SUM(amount) FOR month IN ('JAN', 'FEB')) AS p (k, c, d)", [("K", "DIRECT", "S.T", "K", ""), ("A", "DERIVED", "S.T", "AMOUNT; MONTH", "PIVOT"), ("B", "DERIVED", "S.T", "AMOUNT; MONTH", "PIVOT")]),
    "pivot in a CTE": ("CREATE VIEW V (K, A, B) AS WITH q AS (SELECT * FROM (SELECT t.k, t.m, t.a FROM S.T t) PIVOT (MAX(a) FOR m IN ('x', 'y'))) SELECT k, \"'x'\", y FROM q", [("K", "DIRECT", "S.T", "K", ""), ("A", "DERIVED", "S.T", "A; M", "PIVOT"), ("B", "DERIVED", "S.T", "A; M", "PIVOT")]),
    "unpivot": ("CREATE VIEW V (I, V, N) AS SELECT u.id, u.val, u.name FROM S.T UNPIVOT (val FOR name IN (jan, feb)) u", [("I", "DIRECT", "S.T", "ID", ""), ("V", "DERIVED", "S.T", "FEB; JAN", "UNPIVOT"), ("N", "DERIVED", "CALCULATED", "UNPIVOT", "UNPIVOT")]),
    "connect by": ("CREATE VIEW V (A, B) AS SELECT a, START.b FROM S.T START WITH a IS NULL CONNECT BY PRIOR b = a", [("A", "DIRECT", "S.T", "A", ""), ("B", "UNKNOWN", "UNKNOWN", "UNKNOWN", "")]),
    "connect by in a CTE": ("CREATE VIEW V (A, B) AS WITH c AS (SELECT x.a, x.b FROM S.T x WHERE x.a > 1 CONNECT BY NOCYCLE PRIOR x.b = x.a START WITH x.a IS NULL) SELECT a, b FROM c", [("A", "DIRECT", "S.T", "A", ""), ("B", "DIRECT", "S.T", "B", "")]),
    "exclude": ("CREATE VIEW V (ID, A) AS SELECT t.* EXCLUDE (id, z), u.* FROM S.T t JOIN S.U u ON t.i = u.i", [("ID", "DIRECT", "S.U", "ID", ""), ("A", "DIRECT", "S.T", "A", "")]),
    "exclude in a CTE": ("CREATE VIEW V (ID, A) AS WITH c AS (SELECT * EXCLUDE id FROM S.T) SELECT * FROM c", [("ID", "UNKNOWN", "UNKNOWN", "UNKNOWN", ""), ("A", "DIRECT", "S.T", "A", "")]),
    "rename and replace": ("CREATE VIEW V (B, A, C) AS SELECT * RENAME (a AS b) REPLACE (UPPER(c) AS c) FROM S.T", [("B", "DIRECT", "S.T", "A", ""), ("A", "UNKNOWN", "UNKNOWN", "UNKNOWN", ""), ("C", "DERIVED", "S.T", "C", "UPPER")]),
    "parentheses": ("CREATE VIEW V (A, B) AS SELECT ((t.a)), (((t.a)) + (t.b)) FROM S.T t", [("A", "DIRECT", "S.T", "A", ""), ("B", "DERIVED", "S.T", "A; B", "ADD")]),
    "many parentheses": ("CREATE VIEW V (A) AS SELECT " + "(" * 3000 + "t.a" + ")" * 3000 + " FROM S.T t", [("A", "DIRECT", "S.T", "A", "")]),
    "deep operations": ("CREATE VIEW V (A) AS SELECT " + "(1 + " * 3000 + "t.a" + ")" * 3000 + " FROM S.T t", [("ERROR", "ERROR", "ANALYSIS_ERROR", "ANALYSIS_ERROR", "ERROR")]),
    "voted": ("CREATE VIEW V (P, Q, K) AS WITH a AS (SELECT t.x AS p, t.y + 1 AS q FROM S.T t), b AS (SELECT t.z AS k FROM S.T t) SELECT * FROM b", [("P", "DIRECT", "S.T", "X", ""), ("Q", "DERIVED", "S.T", "Y", "ADD"), ("K", "DIRECT", "S.T", "Z", "")]),
    "missing": (None, [("ERROR", "ERROR", "DDL_NOT_FOUND", "DDL_NOT_FOUND", "ERROR")]),
    "unreadable": ("CREATE VIEW V (A) AS SELEC x", [("ERROR", "ERROR", "ANALYSIS_ERROR", "ANALYSIS_ERROR", "ERROR")]),
}


@pytest.fixture(scope="module")
def lineage(spark):
    rows = view_lineage(spark, [(k, ddl) for k, (ddl, _) in CASES.items()]).collect()
    return {k: sorted(tuple(r)[1:] for r in rows if r["view_name"] == k) for k in CASES}


@pytest.mark.parametrize("case", CASES)
def test_case(lineage, case):
    assert lineage[case] == sorted(CASES[case][1])


def test_chains_of_scopes_of_any_length(spark):
    chain = ", ".join(["c0 AS (SELECT x AS a FROM S.T)", *(f"c{k} AS (SELECT a FROM c{k - 1})" for k in range(1, 24))])
    rows = view_lineage(spark, [("V", f"CREATE VIEW V (A) AS WITH {chain} SELECT a FROM c23")]).collect()
    assert [tuple(r)[1:] for r in rows] == [("A", "DIRECT", "S.T", "X", "")]


def test_cycles_of_scopes_end(spark):
    objects = spark.createDataFrame([("V", "OK", ["A"])], "object string, status string, columns array<string>")
    items = spark.createDataFrame([("V", s, 0, 0, "a") for s in ("main", "r", "q")], "object string, scope string, branch int, ordinal int, out_col string")
    items = items.selectExpr("*", "monotonically_increasing_id() as place")
    links = [("main", "scope", "r", "a"), ("r", "scope", "q", "a"), ("q", "scope", "r", "a"), ("q", "base", "S.T", "x")]
    edges = spark.createDataFrame([("V", s, 0, "a", "", True, [], "qualified", kind, name, col, 0) for s, kind, name, col in links], "object string, scope string, branch int, out_col string, expr string, direct boolean, excluded array<string>, rule string, src_kind string, src_name string, src_col string, position int")
    assert [(r["src_name"], r["src_col"]) for r in resolve(objects, items, edges).collect()] == [("S.T", "x")]


THREE = "CREATE VIEW V (A, B) AS WITH c AS (SELECT x, f.y FROM F1 f JOIN J1 ON f.i = J1.i LEFT JOIN J2 ON f.i = J2.i) SELECT x, y FROM c"


@pytest.mark.parametrize("fallback,table", [("first_from", "F1"), ("first_join", "J1"), ("last_join", "J2")])
def test_precedence_of_sources(spark, fallback, table):
    rows = {tuple(r)[1:] for r in lineage_rules(spark, [("V", THREE)], fallback=fallback).collect()}
    assert rows == {("A", table, "X", fallback), ("B", "F1", "Y", "known_column")}  # as sure as the least sure step
    known = spark.createDataFrame([("J2", "X")], "table_name string, column_names string")
    assert ("A", "J2", "X", "known_column") in {tuple(r)[1:] for r in lineage_rules(spark, [("V", THREE)], known, fallback).collect()}


def test_rules_of_stars_and_votes(spark):
    views = [("S", "CREATE VIEW S (A) AS WITH c AS (SELECT * FROM T1) SELECT c.* FROM c"), ("O", "CREATE VIEW O (A) AS SELECT a FROM T1"), ("W", CASES["voted"][0])]
    rows = {(r["view_name"], r["view_column"], r["rule"]) for r in lineage_rules(spark, views).collect()}
    assert rows == {("S", "A", "wildcard"), ("O", "A", "only_source"), ("W", "P", "cte_vote"), ("W", "Q", "cte_vote"), ("W", "K", "wildcard")}
    with pytest.raises(ValueError):
        view_lineage(spark, views, fallback="nearest")
