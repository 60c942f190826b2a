"""The analyzers over a few literal definitions and files."""

from pyspark.sql import DataFrame, SparkSession

from tracewell.plans.actions import action_mapping
from tracewell.plans.code import backend_routes, code_references, frontend_calls, known_tables, model_fields, nested_fields, orm_classes, orm_columns
from tracewell.plans.lineage import success_rate, view_lineage
from tracewell.plans.python_code import call_facts, function_uses
from tracewell.plans.procedures import column_uses, profile, variables

VIEWS = [
    ("V_ORDERS", "CREATE VIEW V_ORDERS (ORDER_ID, TOTAL) AS SELECT o.ORDER_ID, i.PRICE * i.QTY AS TOTAL FROM SALES.ORDERS o JOIN SALES.ITEMS i ON o.ORDER_ID = i.ORDER_ID"),
    ("V_STARS", "CREATE VIEW V_STARS (A, B) AS WITH c AS (SELECT * FROM S.T) SELECT c.* FROM c"),
    ("V_TOTALS", "CREATE VIEW V_TOTALS (K, TOT) AS WITH c AS (SELECT t.k AS K, SUM(t.v) AS TOT FROM S.T t GROUP BY t.k) SELECT c.K AS K, c.TOT AS TOT FROM c"),
    ("V_BAD", None),
]
PROCEDURES = [
    ("load_orders", "LANGUAGE SQL AS $$ DECLARE tgt VARCHAR; BEGIN tgt := 'SALES.ORDERS_TMP'; CREATE OR REPLACE TEMP TABLE IDENTIFIER(:tgt) AS SELECT o.ORDER_ID FROM SALES.ORDERS o WHERE o.CUST_ID > 3; UPDATE SALES.ITEMS SET QTY = 1 WHERE PRICE > 2; EXECUTE IMMEDIATE 'x'; END; $$", "API"),
    ("refresh", "LANGUAGE PYTHON LANGUAGE SQL LET c CURSOR FOR SELECT NAME FROM CUSTOMERS; INSERT INTO AUDIT SELECT NAME FROM CUSTOMERS ORDER BY NAME;", "API"),
]
FILES = [
    ("alpha/app.py", "alpha", "app.py", "py", 'def load(db):\n    sql = """SELECT o.ORDER_ID, o.CUST_ID FROM SALES.ORDERS o WHERE o.CUST_ID = 3"""\n    return db.execute(sql)\n\ndef purge(db):\n    db.execute("DELETE FROM ORDERS WHERE ORDER_ID = 1")\n    helper(db)\n\ndef helper(db):\n    db.execute(text("CALL LOAD_ORDERS(1) -- with a long comment"))\n'),
    ("alpha/models.py", "alpha", "models.py", "py", 'class Order(Base):\n    __tablename__ = "orders"\n    order_id: int\n    _hidden: int\n    items: list = relationship("Item")\n\nclass OrderRead(BaseModel):\n    id: int\n    items: Optional[List[ItemRead]]\n\nclass ItemRead(BaseModel):\n    sku: str\n    parent: OrderRead\n'),
    ("alpha/routes.py", "alpha", "routes.py", "py", '@router.get("/orders/{order_id}", response_model=OrderRead)\nasync def get_order(order_id: int):\n    return purge(order_id)\n\nfrom alpha.app import purge\n'),
    ("web/orders.ts", "web", "orders.ts", "ts", "export const loadOrders = async (id) => {\n  // client.get('/api/no')\n  const r = await client.get(`${V2_URL}/orders/${order.orderId}?x=1`);\n  return r;\n};\n"),
    ("beta/run.sh", "beta", "run.sh", "sh", "sync_all() {\n  echo orders cust_id\n}\n"),
]
CATALOG = [("ORDERS", "ORDER_ID"), ("ORDERS", "CUST_ID"), ("ITEMS", "QTY")]


def _files(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FILES, "path string, repo_name string, file_name string, extension string, content string")


def _catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATALOG, "table_name string, column_name string")


def _procedures(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PROCEDURES, "procedure_name string, procedure_definition string, procedure_schema string")


def view_lineage_cases(spark: SparkSession, _: str) -> DataFrame:
    return view_lineage(spark, VIEWS)


def view_success_cases(spark: SparkSession, _: str) -> DataFrame:
    return success_rate(view_lineage(spark, VIEWS))


def procedure_profile_cases(spark: SparkSession, _: str) -> DataFrame:
    return profile(_procedures(spark))


def procedure_variable_cases(spark: SparkSession, _: str) -> DataFrame:
    return variables(_procedures(spark))


def procedure_column_cases(spark: SparkSession, _: str) -> DataFrame:
    return column_uses(_procedures(spark))


def code_reference_cases(spark: SparkSession, _: str) -> DataFrame:
    return code_references(_files(spark), _catalog(spark))


def orm_column_cases(spark: SparkSession, _: str) -> DataFrame:
    return orm_columns(_files(spark))


def nested_field_cases(spark: SparkSession, _: str) -> DataFrame:
    return nested_fields(model_fields(_files(spark)))


def function_use_cases(spark: SparkSession, _: str) -> DataFrame:
    files = _files(spark)
    return function_uses(call_facts(files), known_tables(files), orm_classes(files))


def frontend_call_cases(spark: SparkSession, _: str) -> DataFrame:
    return frontend_calls(_files(spark), bases={"V2_URL": "/api/v2"})


def backend_route_cases(spark: SparkSession, _: str) -> DataFrame:
    return backend_routes(_files(spark), [("alpha/", "/api/v2")])


def action_mapping_cases(spark: SparkSession, _: str) -> DataFrame:
    files = _files(spark)
    return action_mapping(files.where("extension = 'ts'"), files.where("extension = 'py'"), [("alpha/", "/api/v2")], {"V2_URL": "/api/v2"})


#: Rows that the definitions above should give.
SQL = {
    "view_lineage_cases": """SELECT * FROM (VALUES
('V_ORDERS', 'ORDER_ID', 'DIRECT', 'SALES.ORDERS', 'ORDER_ID', ''), ('V_ORDERS', 'TOTAL', 'DERIVED', 'SALES.ITEMS', 'PRICE; QTY', 'MUL'),
('V_STARS', 'A', 'DIRECT', 'S.T', 'A', ''), ('V_STARS', 'B', 'DIRECT', 'S.T', 'B', ''),
('V_TOTALS', 'K', 'DIRECT', 'S.T', 'K', ''), ('V_TOTALS', 'TOT', 'DERIVED', 'S.T', 'V', 'SUM'),
('V_BAD', 'ERROR', 'ERROR', 'DDL_NOT_FOUND', 'DDL_NOT_FOUND', 'ERROR')) t(view_name, view_column, column_type, source_table, source_column, expression_type)""",
    "procedure_variable_cases": "SELECT 'load_orders' AS procedure_name, 'tgt' AS variable, 'SALES.ORDERS_TMP' AS value",
    "procedure_profile_cases": """SELECT * FROM (VALUES ('load_orders', 'API', 'SQL', ['TGT'], []::VARCHAR[], true), ('refresh', 'API', 'MIXED', []::VARCHAR[], ['c'], false))
t(procedure_name, procedure_schema, language, temp_tables, cursors, dynamic_sql)""",
    "orm_column_cases": "SELECT 'alpha/models.py' AS path, 'ORDERS' AS table_name, 'ORDER_ID' AS column_name",
    "view_success_cases": "SELECT 7::BIGINT AS n_rows, 4::BIGINT AS n_views, 100.0::DOUBLE * 6 / 7 AS success_percent",
    "procedure_column_cases": """SELECT * FROM (VALUES
('LOAD_ORDERS', 'API', 'SQL', 'SALES.ORDERS', '*', 'USES_TABLE'), ('LOAD_ORDERS', 'API', 'SQL', 'SALES.ORDERS', 'ORDER_ID', 'USED_AS_SELECT'),
('LOAD_ORDERS', 'API', 'SQL', 'SALES.ORDERS', 'CUST_ID', 'USED_AS_FILTER'), ('LOAD_ORDERS', 'API', 'SQL', 'SALES.ITEMS', '*', 'USED_AS_UPDATE,USES_TABLE'),
('LOAD_ORDERS', 'API', 'SQL', 'SALES.ITEMS', 'QTY', 'USED_AS_UPDATE'), ('LOAD_ORDERS', 'API', 'SQL', 'SALES.ITEMS', 'PRICE', 'USED_AS_FILTER'),
('REFRESH', 'API', 'MIXED', 'CUSTOMERS', '*', 'USES_TABLE'), ('REFRESH', 'API', 'MIXED', 'CUSTOMERS', 'NAME', 'USED_AS_ORDER_BY,USED_AS_SELECT'),
('REFRESH', 'API', 'MIXED', 'AUDIT', '*', 'USED_AS_INSERT')) t(sp_name, sp_schema, sp_language, table_name, column_name, relationship_types)""",
    "code_reference_cases": """SELECT * FROM (VALUES
('alpha', 'load', 'ORDERS', 'ORDER_ID', 'app.py'), ('alpha', 'load', 'ORDERS', 'CUST_ID', 'app.py'), ('alpha', 'purge', 'ORDERS', '', 'app.py'),
('alpha', 'purge', 'ORDERS', 'ORDER_ID', 'app.py'), ('alpha', 'main_content', 'ORDERS', 'ORDER_ID', 'models.py'), ('alpha', 'get_order', 'ORDERS', 'ORDER_ID', 'routes.py'),
('beta', 'sync_all', 'ORDERS', 'CUST_ID', 'run.sh')) t(repo_name, function_name, table_name, column_name, file_name)""",
    "nested_field_cases": """SELECT * FROM (VALUES ('OrderRead', 'id'), ('OrderRead', 'items'), ('OrderRead', 'items.sku'), ('OrderRead', 'items.parent'),
('ItemRead', 'sku'), ('ItemRead', 'parent'), ('ItemRead', 'parent.id'), ('ItemRead', 'parent.items')) t(model, dotted)""",
    "function_use_cases": """SELECT * FROM (VALUES
('alpha/app.py', 'purge', 'table', 'ORDERS'), ('alpha/app.py', 'purge', 'procedure', 'LOAD_ORDERS'), ('alpha/app.py', 'helper', 'procedure', 'LOAD_ORDERS'),
('alpha/routes.py', 'get_order', 'table', 'ORDERS'), ('alpha/routes.py', 'get_order', 'procedure', 'LOAD_ORDERS')) t(path, "function", kind, name)""",
    "frontend_call_cases": """SELECT 'web/orders.ts' AS path, 3::BIGINT AS line, 'loadOrders' AS "function", 'GET' AS method, '/api/v2/orders/{orderId}' AS url""",
    "backend_route_cases": """SELECT 'alpha/routes.py' AS path, 2::BIGINT AS line, 'get_order' AS "function", 'GET' AS method, '/api/v2/orders/{order_id}' AS route, 'OrderRead' AS response_model""",
    "action_mapping_cases": """SELECT 'orders.ts' AS frontend_file, 'loadOrders' AS frontend_function, 'GET' AS http_method, '/api/v2/orders/{orderId}' AS frontend_url,
'routes.py' AS backend_file, 'get_order' AS backend_function, '/api/v2/orders/{order_id}' AS backend_route, 'ORDERS' AS database_tables, 'LOAD_ORDERS' AS stored_procedures,
'' AS flow_calls, 'OrderRead' AS response_model, 'id,items' AS response_fields, 'items.parent,items.sku' AS nested_fields, 'ORDERS:[ORDER_ID]' AS table_column_details""",
}
