"""Sources, sinks, serving, relations on small tables, and properties of the rewritten joins."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell import schemas, sinks
from tracewell.config import Catalog
from tracewell.functions.names import model_name, normal_url
from tracewell.operators.aggregates import percentages
from tracewell.operators.closure import reachable, roots_and_levels
from tracewell.operators.joins import suffix_join, word_references
from tracewell.plans.code import nested_fields
from tracewell.plans.relations import action_table_columns, dashboards_with_keys, lineage_with_keys, procedure_columns, procedure_triggers, repo_references
from tracewell.serve import Server
from tracewell.sources import catalog, files
from tracewell.streaming.corpus import search_arriving


@pytest.fixture(scope="module")
def base(spark):
    names = spark.createDataFrame([(1, "ORDERS"), (2, "SALES.CUSTOMERS"), (3, "DB.SALES.ITEMS"), (4, "HR.CUSTOMERS")], schemas.BASE_NAMES)
    rows = [(10, "ORDERS", "BASE TABLE", "ORDER_ID", "NUMBER(38,0)", "COLUMN", "Y", "SALES", 1), (11, "ORDERS", "BASE TABLE", "CUST_ID", "NUMBER(38,0)", "COLUMN", "N", "SALES", 1), (12, "CUSTOMERS", "BASE TABLE", "CUST_ID", "NUMBER(38,0)", "COLUMN", "Y", "SALES", 2), (14, "MISSING_T", "NOT_FOUND", None, None, None, None, None, None)]
    views = spark.createDataFrame([(1, "V_ORDERS", "ORDER_ID", "NUMBER(38,0)", "API"), (2, "V_ORDERS", "TOTAL", "NUMBER(38,2)", "API")], schemas.VIEW_TABLE)
    return names, spark.createDataFrame(rows, schemas.BASE_TABLE), views


@pytest.fixture(scope="module")
def actions(spark):
    row = ("orders.ts", "loadOrders", "GET", "/orders/{id}", "orders.py", "get_order", "/orders/{order_id}", "ORDERS;CUSTOMERS", "LOAD_ORDERS,IDENTIFIER", "", "OrderRead", "id", "", " ORDERS:[CUST_ID, order_id];CUSTOMERS:[unknown];junk")
    return spark.createDataFrame([row, ("x.ts", "f", "GET", "/x", *[""] * 9, None)], schemas.ACTION_MAPPING)


def cells(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_action_table_columns(base, actions):
    names, table, _ = base
    got = action_table_columns(actions, names, table).orderBy("id").select("id", "table_name", "column_name", "table_key", "column_key").collect()
    assert [tuple(r) for r in got] == [(1, "CUSTOMERS", "unknown", None, None), (2, "ORDERS", "CUST_ID", 1, 11), (3, "ORDERS", "order_id", 1, 10)]


def test_lineage_with_keys(spark, base):
    rows = [("V_ORDERS", "TOTAL", "DERIVED", "SALES.ITEMS; SALES.ORDERS", "PRICE; QTY", "MUL"), ("V_ORDERS", "ORDER_ID", "DIRECT", "SALES.ORDERS AS O", "ORDER_ID", ""), ("V", "A", "DIRECT", None, "X", "")]
    got = lineage_with_keys(spark.createDataFrame(rows, schemas.LINEAGE), base[1], base[2])
    assert cells(got, "view_column", "source_table", "base_schema", "table_key", "view_key") == [("ORDER_ID", "ORDERS", "SALES", 10, 1), ("TOTAL", "ITEMS", "SALES", None, 2), ("TOTAL", "ORDERS", "SALES", None, 2)]


def test_dashboards_with_keys(spark, base):
    rows = [("ORDERS", "b", "g", "SALES", "BASE TABLE"), ("orders", "b", "g", "SALES", "BASE TABLE"), ("CUSTOMERS", "b", "g", "SALES", "BASE TABLE"), ("V_ORDERS", "b", "g", "X", "VIEW"), ("ITEMS", "b", "g", None, "VIEW")]
    views = spark.createDataFrame([(7, "V_ORDERS")], schemas.VIEW_NAMES)
    got = dashboards_with_keys(spark.createDataFrame(rows, schemas.DASHBOARDS), base[0], views)
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r) for r in got.select("table_name", "base_primary_id", "view_primary_id").collect()) == order([("ORDERS", 1, None), ("orders", None, None), ("CUSTOMERS", 2, None), ("CUSTOMERS", 4, None), ("V_ORDERS", None, 7), ("ITEMS", None, None)])


def test_procedures(spark, base, actions):
    rows = [("LOAD_ORDERS", "API", "SQL", "SALES.ORDERS", "ORDER_ID", "USED_AS_FILTER"), ("OTHER", "API", "SQL", "NOWHERE", "X", "")]
    columns = procedure_columns(spark.createDataFrame(rows, schemas.PROCEDURE_COLUMNS), base[0], base[1])
    assert cells(columns, "sp_name", "base_table_id", "base_column_id") == [("LOAD_ORDERS", 1, 10)]
    flows = spark.createDataFrame([("LOAD_ORDERS", "a", "beta"), ("LOAD_ORDERS", "b", "alpha"), ("load_orders", "c", "gamma")], schemas.PROCEDURE_FLOWS)
    got = procedure_triggers(columns, flows, actions)
    assert cells(got, "trigger_type", "source_reference") == [("flow_triggered,api_triggered", "alpha,beta"), ("flow_triggered,api_triggered", "gamma")]


def test_repo_references(spark, base):
    refs = spark.createDataFrame([("alpha", "purge", " orders", "", "p.py"), ("alpha", "f", "V_ORDERS", "total", "p.py")], schemas.REPO_REFERENCES)
    got = repo_references(refs, base[1], base[2])
    assert sorted(map(str, got.select("base_key", "view_key").collect())) == sorted(["Row(base_key=10, view_key=None)", "Row(base_key=11, view_key=None)", "Row(base_key=None, view_key=2)"])


def test_suffix_join_is_the_naive_join(spark):
    rng = random.Random(1)
    name = lambda: ".".join(rng.choice(["a", "B", "c"]) for _ in range(rng.randrange(1, 4)))
    a, b = spark.createDataFrame([(name(),) for _ in range(60)], "a string"), spark.createDataFrame([(name(),) for _ in range(60)], "b string")
    last = lambda c: F.upper(F.split_part(c, F.lit("."), F.lit(-1)))
    naive = a.join(b, (F.upper("a") == F.upper("b")) | (F.upper("a") == last(F.col("b"))) | (last(F.col("a")) == F.upper("b")), "left")
    assert cells(suffix_join(a, b, "a", "b"), "a", "b") == cells(naive, "a", "b")
    assert "NestedLoop" not in suffix_join(a, b, "a", "b")._jdf.queryExecution().executedPlan().toString()


def test_word_references_are_word_bounded(spark):
    texts = spark.createDataFrame([(1, "call Load_Orders; x"), (2, "load_orders2"), (3, "a load-orders b"), (4, None), (3, "a load-orders b")], "id int, content string")
    names = spark.createDataFrame([("LOAD_ORDERS",), ("load-orders",), ("",), (None,)], "name string")
    assert cells(word_references(texts, names, "content", "name"), "id", "name") == [(1, "LOAD_ORDERS"), (3, "load-orders"), (3, "load-orders")]


def test_closure_is_monotone_and_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "s string, t string")
    sizes = [reachable(edges, "s", "t", k).count() for k in (1, 2, 3, 9)]
    assert sizes == sorted(sizes) and sizes[-1] == 9


def test_levels_and_fields_of_any_depth(spark):
    edges = spark.createDataFrame([*((k + 1, k) for k in range(52)), (100, 101), (101, 100)], "s int, t int")
    assert {r["node"]: r["level"] for r in roots_and_levels(edges, "s", "t").collect()} == {k: k for k in range(53)} | {100: None, 101: None}
    fields = spark.createDataFrame([*((f"M{k}Read", "f", f"M{k + 1}Read") for k in range(8)), ("M8Read", "end", "int"), ("M8Read", "up", "M0Read")], "model string, field string, annotation string")
    got = {r["dotted"] for r in nested_fields(fields).where("model = 'M0Read'").collect()}
    assert got == {".".join(["f"] * k) for k in range(1, 9)} | {".".join([*["f"] * 8, x]) for x in ("end", "up")}


def test_catalog(spark):
    tables = spark.createDataFrame([("D", "S1", "ORDERS", "BASE TABLE"), ("D", "S2", "ORDERS", "VIEW"), ("D", "S2", "CANVAS_X", "BASE TABLE"), ("E", "S2", "ITEMS", "VIEW")], "table_catalog string, table_schema string, table_name string, table_type string")
    assert cells(catalog.objects(tables, Catalog(schemas=("S2",), excluded_like=("CANVAS_%",))), "table_name") == [("ITEMS",), ("ORDERS",)]
    names = spark.createDataFrame([("orders",), ("S1.ORDERS",), ("D.S2.orders",), ("NONE_T",)], "table_name string")
    got = catalog.locate(names, tables, ("S2", "S1"))
    assert cells(got, "table_name", "table_type") == [("D.S2.orders", "VIEW"), ("NONE_T", "NOT_FOUND"), ("S1.ORDERS", "BASE TABLE"), ("orders", "VIEW")]


def test_files(spark, tmp_path):
    (tmp_path / "alpha" / "venv").mkdir(parents=True)
    (tmp_path / "alpha" / "venv" / "no.py").write_text("x")
    (tmp_path / "alpha" / "main.py").write_text("from prefect import flow")
    (tmp_path / "alpha" / "latin.txt").write_text("x")
    (tmp_path / "top.py").write_bytes("é".encode("latin-1"))
    got = files.code_files(spark, str(tmp_path))
    assert cells(got, "path", "repo_name", "content") == [("alpha/main.py", "alpha", "from prefect import flow"), ("top.py", "unknown", "é")]
    assert cells(files.workflow_repos(got, ["flows$"], ["prefect.yaml"], [r"from prefect import"]), "repo_name") == [("alpha",)]
    (tmp_path / "names.csv").write_bytes("﻿1,ALPHA\n2,B\n".encode())
    assert cells(files.csv(spark, str(tmp_path / "names.csv"), "id int, name string", header=False), "id", "name") == [(1, "ALPHA"), (2, "B")]


def test_sinks(spark, tmp_path, actions):
    sinks.write_csv(actions.limit(0), str(tmp_path / "empty"), files=1)
    assert spark.read.csv(str(tmp_path / "empty"), header=True).columns == actions.columns
    sinks.append_run(actions, str(tmp_path / "runs"), "r1")
    sinks.append_run(actions, str(tmp_path / "runs"), "r2")
    assert spark.read.csv(str(tmp_path / "runs"), header=True).groupBy("run_ts").count().count() == 2
    assert cells(sinks.mapping_rows(actions.drop("flow_calls")), "flow_calls") == [("",), ("",)]
    assert cells(actions.select(sinks.relationship_type("database_tables").alias("r")), "r") == [("multi_table_join",), ("unmatched",)]


def test_server(base):
    server = Server({"BASE_NAMES": base[0], "SECRETS": base[0]})
    assert server.resources() == ["BASE_NAMES"]
    assert len(json.loads(server.query_json("base_names", where="table_name like '%CUST%'"))) == 2
    assert server.schema("BASE_NAMES")[0] == ("base_primary_id", "int", True)
    assert server.search("1 orders")["BASE_NAMES"]["total"] == 1
    for bad in (lambda: server.query("SECRETS"), lambda: server.query("BASE_NAMES", 10_001), lambda: server.query("BASE_NAMES", where="1 in (select 1)")):
        with pytest.raises(Exception):
            bad()


def test_streaming_search(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("calls load_orders here")
    names = spark.createDataFrame([("LOAD_ORDERS",), ("OTHER",)], "name string")
    search_arriving(spark, str(tmp_path / "in"), names, "name", str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert cells(spark.read.parquet(str(tmp_path / "out")), "name") == [("LOAD_ORDERS",)]


def test_names(spark):
    got = spark.range(1).select(normal_url(F.lit("${V2_URL}/a/${x.y.orderId}/${userName}?q=${z}"), {"V2_URL": "/api/v2"}).alias("u"), model_name(F.lit("Optional[List[ItemRead]]")).alias("m"), model_name(F.lit("Dict[str, ItemRead]")).alias("d")).first()
    assert tuple(got) == ("/api/v2/a/{orderId}/{user_name}", "ItemRead", "ItemRead")
    assert schemas.parse_type("NUMBER(38,2)") == T.DecimalType(38, 2) and schemas.parse_type("VARCHAR(9)") == T.StringType()


def test_percentages_of_nothing(spark):
    assert tuple(percentages(spark.range(0), some=F.col("id") > 1).first()) == (0, 0, 0.0)


def test_functions_of_one_name_and_mapped_classes(spark):
    from tracewell.plans.actions import action_mapping

    route = lambda name, body: f'@router.get("/{name}")\ndef get_items():\n    return helper()\n\ndef helper():\n    return {body}\n'
    backend = [
        ("api/a.py", route("a", 'db.execute("SELECT x FROM TAB_A WHERE x > 1")')),
        ("api/b.py", route("b", "db.scalars(select(ThingB).where(ThingB.idb == 1))")),
        ("models.py", 'class ThingA(Base):\n    __tablename__ = "tab_a"\n    x: int\n\nclass ThingB(Base):\n    __tablename__ = "tab_b"\n    idb: int\n'),
    ]
    frontend = [("web/x.ts", "export const loadA = async () => {\n  return client.get(`/a`);\n};\nexport const loadB = async () => {\n  return tsClient.get(`/b/long`);\n};\nexport const loadB2 = async () => {\n  return tsClient.get(`${API_URL}/b`);\n};\n")]
    code = lambda rows: spark.createDataFrame(rows, "path string, content string")
    rows = action_mapping(code(frontend), code(backend), [("api/", "/api")], {"API_URL": "/api"}, ("client", "tsClient")).collect()
    got = {r["frontend_function"]: (r["backend_file"], r["database_tables"], r["table_column_details"]) for r in rows}
    assert got["loadB2"] == ("b.py", "TAB_B", "TAB_B:[IDB]")


def test_contained_names_of_any_length(spark):
    from tracewell.operators.joins import contained_names

    texts = spark.createDataFrame([("select a from t1",), ("x",), ("",), (None,)], "text string")
    names = spark.createDataFrame([("t1",), ("x",), ("from",), ("none",), ("",), (None,)], "name string")
    assert {(r["text"], r["name"]) for r in contained_names(texts, names, "text", "name").collect()} == {("select a from t1", "t1"), ("select a from t1", "from"), ("x", "x")}


def test_contained_names_that_begin_alike(spark):
    """Candidates stay near the matches though all names and texts share their first characters; results equal all pairs."""
    import random
    from collections import Counter

    from tracewell.operators.joins import contained_names, likely_names

    rng = random.Random(5)
    code = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5))
    names = ["http://host/items/" + code() for _ in range(10_000)]
    texts = [f"see {rng.choice(names)} or http://host/items/{code()}" for _ in range(600)]
    t = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    n = spark.createDataFrame([(x, k) for k, x in enumerate(names)], "name string, k int")
    got = contained_names(t.union(t.where("id < 5")), n, "text", "name")
    assert got.columns == ["id", "text", "name", "k"]
    places = {}
    for k, x in enumerate(names):
        places.setdefault(x, []).append(k)
    want = Counter((i, k) for i, text in [*enumerate(texts), *enumerate(texts[:5])] for w in {w for w in text.split() if w in places} for k in places[w])
    assert Counter((r["id"], r["k"]) for r in got.collect()) == want
    assert likely_names(t, n, "text", "name", "id").count() < 600 * 60  # of 6 million pairs


def test_view_definitions_in_one_listing(spark, tmp_path):
    from tracewell.sources.catalog import view_definitions

    spark.sql(f"CREATE DATABASE shelf LOCATION '{tmp_path}'")
    try:
        spark.sql("CREATE TABLE shelf.t (k int, v string) USING parquet")
        spark.sql("CREATE VIEW shelf.v1 (a, `b c`) AS SELECT k, v FROM shelf.t\nWHERE k > 1")
        spark.sql("CREATE VIEW shelf.v2 AS SELECT k, struct(k, 2 AS z) AS s FROM shelf.t")
        got = {r["view_name"]: r["ddl"] for r in view_definitions(spark, ["shelf", "shelf"]).collect()}
        assert got == {
            "shelf.v1": "CREATE VIEW shelf.v1 (`a`, `b c`) AS SELECT k, v FROM shelf.t\nWHERE k > 1",
            "shelf.v2": "CREATE VIEW shelf.v2 (`k`, `s`) AS SELECT k, struct(k, 2 AS z) AS s FROM shelf.t",
        }
        assert [r["view_name"] for r in view_definitions(spark, ["shelf"], "v1").collect()] == ["shelf.v1"]
        assert view_definitions(spark, []).count() == 0
        spark.sql("DROP VIEW shelf.v1")
        spark.sql(got["shelf.v1"])  # what is put together is a definition that runs
    finally:
        spark.sql("DROP DATABASE shelf CASCADE")


def test_similar_segments_against_all_pairs(spark):
    import random

    from tracewell.operators.joins import match_routes, similar_segments

    rng = random.Random(21)
    path = lambda: "/api/v2/" + "/".join(rng.choices("abcdefg", k=rng.randrange(1, 6)))
    calls, routes = [(k, path(), rng.choice(["GET", "PUT"])) for k in range(150)], [(k, path(), rng.choice(["GET", "PUT"])) for k in range(80)]
    alike = lambda a, b: len(set(a.split("/")) & set(b.split("/"))) / len(set(a.split("/")) | set(b.split("/")))
    c, r = spark.createDataFrame(calls, "_call long, _path string, _method string"), spark.createDataFrame(routes, "_rank long, _path string, _method string")
    got = {tuple(x) for x in similar_segments(c, r, 0.6).collect()}
    assert {(i, j) for i, a, m in calls for j, b, n in routes if m == n and alike(a, b) >= 0.6} <= got
    matched = match_routes(c.selectExpr("_call as n", "_path as url", "_method as method"), r.selectExpr("_rank as place", "_path as route", "_method as method"), "url", "route", "method", "place").collect()
    for x in matched:
        best = max(((alike(x["url"], b), -j) for j, b, n in routes if n == x["method"] and b.strip("/") != x["url"].strip("/")), default=(0, 0))
        exact = [j for j, b, n in routes if n == x["method"] and b.strip("/") == x["url"].strip("/")]
        assert x["route_place"] == (exact[0] if exact else -best[1] if best[0] > 0.6 else None)


def test_segments_that_all_paths_share_make_no_pairs(spark):
    from tracewell.operators.joins import similar_segments

    c = spark.range(2000).selectExpr("id as _call", "concat('/api/v2/c', id, '/x', id, '/list') as _path", "'GET' as _method")
    r = spark.range(2000).selectExpr("id as _rank", "concat('/api/v2/c', id + 1000, '/y', id, '/list') as _path", "'GET' as _method")
    assert similar_segments(c, r, 0.6).count() <= 1000  # of 4,000,000 pairs that share api, v2 and list


def test_definitions_and_procedures(spark):
    procedures = spark.createDataFrame([("B", "d1", "MY_API"), ("A", "d2", "API"), ("A", "d3", "X"), (None, None, None)], "procedure_name string, procedure_definition string, procedure_schema string")
    assert cells(catalog.procedures_like(procedures, "API"), "procedure_name") == [("A",), ("B",)]
    assert [r[0] for r in catalog.procedure_names(procedures).collect()] == ["A", "B"]
    tables = spark.createDataFrame([("D", "S1", "V", "VIEW"), ("D", "S2", "V", "VIEW")], "table_catalog string, table_schema string, table_name string, table_type string")
    ddl = spark.createDataFrame([("S1", "V", "one"), ("S2", "V", "two")], "table_schema string, table_name string, ddl string")
    names = spark.createDataFrame([("v",), ("S1.V",), ("W",)], "view_name string")
    assert cells(catalog.definitions_of(names, ddl, tables, ("S2",)), "view_name", "ddl") == [("S1.V", "one"), ("W", None), ("v", "two")]


def test_failed_appends_leave_a_backup(spark, tmp_path):
    rows = spark.range(5)
    good = str(tmp_path / "good")
    assert sinks.append_or_back_up(rows, good, str(tmp_path / "b0")) == good and sinks.append_or_back_up(rows, good, str(tmp_path / "b0")) == good
    assert spark.read.parquet(good).count() == 10
    blocked = tmp_path / "file"
    blocked.write_text("not a folder")
    assert sinks.append_or_back_up(rows, str(blocked), str(tmp_path / "b1")) == str(tmp_path / "b1")
    assert blocked.read_text() == "not a folder" and spark.read.parquet(str(tmp_path / "b1")).count() == 5


def test_totals_of_a_run(spark, tmp_path):
    uses = spark.createDataFrame([("P", "T1"), ("P", "T2"), ("Q", "T1")], "sp_name string, table_name string")
    assert sinks.run_totals(uses, str(tmp_path / "u")) == {"n_relations": 3, "n_procedures": 2, "n_tables": 2, "relations_a_procedure": 1.5}
    assert sinks.run_totals(uses.limit(0), str(tmp_path / "v"))["relations_a_procedure"] == 0.0
    sinks.write_names(uses.select("table_name").distinct(), str(tmp_path / "names"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "names")).collect()) == ["T1", "T2"]


def test_unmapped_and_majority(spark):
    from tracewell.operators.aggregates import majority_source, unmapped

    rows = spark.createDataFrame([("a", None), ("a", None), ("b", "x"), ("c", None)], "k string, v string")
    assert cells(unmapped(rows, "k", "v"), "k", "n") == [("a", 2), ("c", 1)]
    missing = spark.createDataFrame([("v", c) for c in "pqr"], "object string, column string")
    definitions = spark.createDataFrame([("v", "p", "one", 1), ("v", "p", "two", 2), ("v", "q", "two", 2), ("v", "q", "three", 3), ("v", "r", "three", 3)], "object string, column string, source string, place int")
    assert cells(majority_source(missing, definitions, ["object"], "column", "source", "place"), "source") == [("two",)]
