"""What procedures use, by the token reader."""

from tracewell.plans.procedures import column_uses, profile, variables

BODY = """CREATE PROCEDURE p() RETURNS VARCHAR LANGUAGE SQL AS $$ DECLARE res RESULTSET; BEGIN
LET tmp VARCHAR := "SALES.TMP_1"; SET X='A.B'; nm := T_PREF || RANDSTR(5, RANDOM()); -- note := 'NO.PE'
CREATE OR REPLACE TEMPORARY TABLE IDENTIFIER(:tmp) AS SELECT l.k FROM A.L l;
FOR r IN (SELECT k FROM A.L) DO MERGE INTO S.T t USING S.U u ON t.id = u.id WHEN MATCHED THEN UPDATE SET t.v = u.v; END FOR;
res := (SELECT a.x FROM A1 a JOIN B1 b ON a.k = b.k GROUP BY a.x HAVING COUNT(b.z) > 1 ORDER BY a.x);
LET c1 CURSOR FOR SELECT n FROM N1 WHERE n > (SELECT MAX(m.n) FROM M1 m);
DELETE FROM D.E WHERE ts < 3; UPDATE IDENTIFIER(:x) SET q = 1 WHERE i > 0; INSERT INTO G (a) SELECT * FROM H; EXECUTE IMMEDIATE 'x'; not ( sql; END $$"""


def table(spark):
    return spark.createDataFrame([("p", "s", BODY), ("none", None, None)], "procedure_name string, procedure_schema string, procedure_definition string")


def test_uses(spark):
    got = {(r["table_name"], r["column_name"]): r["relationship_types"] for r in column_uses(table(spark)).collect()}
    used = "USES_TABLE"
    assert got == {
        ("A.L", "*"): used, ("A.L", "K"): "USED_AS_SELECT", ("S.T", "*"): f"USED_AS_MERGE,{used}", ("S.T", "ID"): "USED_AS_MERGE", ("S.T", "V"): "USED_AS_MERGE",
        ("S.U", "*"): used, ("S.U", "ID"): "USED_AS_MERGE", ("S.U", "V"): "USED_AS_MERGE", ("A1", "*"): used, ("A1", "X"): "USED_AS_GROUP_BY,USED_AS_ORDER_BY,USED_AS_SELECT",
        ("A1", "K"): "USED_AS_JOIN", ("B1", "*"): used, ("B1", "K"): "USED_AS_JOIN", ("B1", "Z"): "USED_AS_HAVING", ("N1", "*"): used, ("N1", "N"): "USED_AS_FILTER,USED_AS_SELECT",
        ("M1", "*"): used, ("M1", "N"): "USED_AS_SELECT", ("D.E", "*"): f"USED_AS_DELETE,{used}", ("D.E", "TS"): "USED_AS_DELETE", ("A.B", "*"): f"USED_AS_UPDATE,{used}",
        ("A.B", "Q"): "USED_AS_UPDATE", ("A.B", "I"): "USED_AS_FILTER", ("G", "*"): "USED_AS_INSERT", ("G", "A"): "USED_AS_INSERT", ("H", "*"): f"USED_AS_SELECT,{used}",
    }


def test_profile_and_variables(spark):
    rows = {r["procedure_name"]: r for r in profile(table(spark)).collect()}
    assert tuple(rows["p"])[1:] == ("s", "SQL", ["TMP"], ["c1"], True) and tuple(rows["none"])[1:] == (None, "SQL", [], [], False)
    assert {(r["variable"], r["value"]) for r in variables(table(spark)).collect()} == {("tmp", "SALES.TMP_1"), ("nm", "T_PREF")}
