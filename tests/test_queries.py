"""The registered queries against their SQL in DuckDB, at the smallest scale."""

import os

import duckdb
import pandas as pd
import pytest

import samples
from tracewell.plans import cases, queries, relation_queries  # noqa: F401 (registers its queries)

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def rows(df: pd.DataFrame) -> list[tuple]:
    def text(v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NA:
            return "null"
        return f"{float(v):.6f}" if isinstance(v, int | float) and not isinstance(v, bool) else str(v)

    return sorted(tuple(text(v) for v in r) for r in df[sorted(df.columns)].astype(object).where(df.notna(), None).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return con


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, duck, name):
    got, want = queries.QUERIES[name](spark, DATA).toPandas(), duck.execute(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", samples.SQL)
def test_sample(spark, duck, name):
    got, want = getattr(samples, name)(spark, "").toPandas(), duck.execute(samples.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", cases.SQL)
def test_case(spark, duck, name):
    got, want = cases.QUERIES[name](spark, DATA).toPandas(), duck.execute(cases.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def _cells(df):
    return {tuple(str(v) for v in r) for r in df.collect()}


def test_code_cases(spark):
    refs = _cells(samples.code_reference_cases(spark, ""))
    assert ("alpha", "load", "ORDERS", "CUST_ID", "app.py") in refs and ("alpha", "purge", "ORDERS", "", "app.py") in refs and ("beta", "sync_all", "ORDERS", "CUST_ID", "run.sh") in refs
    assert _cells(samples.orm_column_cases(spark, "")) == {("alpha/models.py", "ORDERS", "ORDER_ID")}
    assert _cells(samples.frontend_call_cases(spark, "")) == {("web/orders.ts", "3", "loadOrders", "GET", "/api/v2/orders/{orderId}")}
    assert _cells(samples.backend_route_cases(spark, "")) == {("alpha/routes.py", "2", "get_order", "GET", "/api/v2/orders/{order_id}", "OrderRead")}
    assert {("alpha/app.py", "purge", "procedure", "LOAD_ORDERS"), ("alpha/routes.py", "get_order", "procedure", "LOAD_ORDERS"), ("alpha/app.py", "purge", "table", "ORDERS")} <= _cells(samples.function_use_cases(spark, ""))
    assert ("OrderRead", "items.sku") in _cells(samples.nested_field_cases(spark, ""))


def test_procedure_cases(spark):
    assert _cells(samples.procedure_variable_cases(spark, "")) == {("load_orders", "tgt", "SALES.ORDERS_TMP")}
    profile = {r["procedure_name"]: r for r in samples.procedure_profile_cases(spark, "").collect()}
    assert profile["load_orders"]["dynamic_sql"] and profile["load_orders"]["temp_tables"] == ["TGT"] and profile["refresh"]["language"] == "MIXED" and profile["refresh"]["cursors"] == ["c"]
    uses = {(r["sp_name"], r["table_name"], r["column_name"]): r["relationship_types"] for r in samples.procedure_column_cases(spark, "").collect()}
    assert uses["LOAD_ORDERS", "SALES.ORDERS", "CUST_ID"] == "USED_AS_FILTER" and uses["REFRESH", "CUSTOMERS", "NAME"] == "USED_AS_ORDER_BY,USED_AS_SELECT"


def test_action_mapping(spark):
    rows = samples.action_mapping_cases(spark, "").collect()
    assert [r.asDict() for r in rows] == [{
        "frontend_file": "orders.ts", "frontend_function": "loadOrders", "http_method": "GET", "frontend_url": "/api/v2/orders/{orderId}", "backend_file": "routes.py", "backend_function": "get_order",
        "backend_route": "/api/v2/orders/{order_id}", "database_tables": "ORDERS", "stored_procedures": "LOAD_ORDERS", "flow_calls": "", "response_model": "OrderRead", "response_fields": "id,items",
        "nested_fields": "items.parent,items.sku", "table_column_details": "ORDERS:[ORDER_ID]",
    }]
