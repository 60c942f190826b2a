"""What functions use: through imports, re-exports, receivers, inheritance and variables."""

import pytest

from tracewell.plans.code import PrefixRule, backend_routes, known_tables, orm_classes, path_prefix
from tracewell.plans.python_code import call_facts, function_uses, router_prefixes

FILES = {
    "app/orm/tables.py": 'from sqlalchemy import Table\norders_t = Table("orders_core", meta)\nitems_t: Table = Table("items_core", meta)\nNAME = "audit_log"\n',
    "app/orm/__init__.py": "from .tables import orders_t, items_t as lines\nfrom .tables import *\n",
    "app/orm/models.py": 'class Base: pass\nclass Client(Base):\n    __tablename__ = "clients"\n    id: int\n',
    "app/service.py": (
        "from app.orm import lines\nfrom app.orm.models import Client\nimport app.orm.tables as tb\n"
        "class Root:\n    def shared(self):\n        return select(lines.c.id)\n    def over(self):\n        db.call(proc_name='from_root')\n"
        "class S(Root):\n    def __init__(self):\n        self.other = Other()\n    def run(self):\n        return self.inner()\n    def inner(self):\n        q = tb.orders_t\n        r = q\n        return select(r.c.x)\n"
        "    def up(self):\n        return super().over()\n    def over(self):\n        pass\n    def by_field(self):\n        return self.other.work()\n    def inherited(self):\n        return self.shared()\n"
        "class Other:\n    def work(self):\n        return session.query(Client)\n"
        "one = S()\n"
    ),
    "app/routes.py": (
        "from app.service import S, one\nfrom app import service\nfrom app.orm import orders_t, NAME\n"
        "def made():\n    return S().run()\n"
        "def held():\n    s = S()\n    return s.inherited()\n"
        "def annotated(s: S):\n    return s.up()\n"
        "def module_object():\n    return one.by_field()\n"
        "def through_module():\n    return service.S().run()\n"
        "async def within():\n    async with S() as s:\n        await s.run()\n"
        "def direct():\n    return select(orders_t.c.id)\n"
        "def by_text():\n    return db.execute(NAME)\n"
        "def chosen(kind):\n    match kind:\n        case 1:\n            table_name = 'items_core'\n        case _:\n            table_name = 'orders_core'\n    return table_name\n"
        "def looked_up(kind):\n    return {1: orders_t}[kind]\n"
        "def nested():\n    def deep():\n        return CALLS()\n    return deep()\n"
        "def CALLS():\n    return db.execute('CALL LOAD_ALL(1)')\n"
        "def renamed():\n    return client.rebuild_all()\n"
        "def same_name():\n    return elsewhere()\n"
        "def untyped(x):\n    return x.run()\n"
    ),
    "other/unrelated.py": "from app.orm import orders_t\ndef elsewhere():\n    return orders_t.c.id\ndef direct():\n    with FlowClient() as f:\n        f.start_it()\n",
    "other/broken.py": "def (:\n",
    "other/empty.py": None,
}


@pytest.fixture(scope="module")
def uses(spark):
    files = spark.createDataFrame(list(FILES.items()), "path string, content string")
    renamed = spark.createDataFrame([("rebuild_all", "dc_rebuild")], "function string, name string")
    rows = function_uses(call_facts(files), known_tables(files), orm_classes(files), procedures=renamed).collect()
    found = {}
    for r in rows:
        found.setdefault((r["path"], r["function"]), set()).add((r["kind"], r["name"]))
    return found


T = {n: {("table", n)} for n in ("ORDERS_CORE", "ITEMS_CORE", "CLIENTS")}


@pytest.mark.parametrize("function,want", [
    ("made", T["ORDERS_CORE"]), ("held", T["ITEMS_CORE"]), ("annotated", {("procedure", "FROM_ROOT")}), ("module_object", T["CLIENTS"]), ("through_module", T["ORDERS_CORE"]),
    ("within", T["ORDERS_CORE"]), ("direct", T["ORDERS_CORE"]), ("by_text", None), ("chosen", T["ORDERS_CORE"] | T["ITEMS_CORE"]), ("looked_up", T["ORDERS_CORE"]),
    ("nested", {("procedure", "LOAD_ALL")}), ("nested.deep", {("procedure", "LOAD_ALL")}), ("renamed", {("procedure", "DC_REBUILD")}), ("same_name", None), ("untyped", None),
])
def test_uses(uses, function, want):
    assert uses.get(("app/routes.py", function)) == want


def test_methods(uses):
    at = lambda f: uses.get(("app/service.py", f))
    assert at("S.run") == at("S.inner") == T["ORDERS_CORE"] and at("S.inherited") == at("Root.shared") == T["ITEMS_CORE"]
    assert at("S.up") == {("procedure", "FROM_ROOT")} and at("S.over") is None and at("S.by_field") == at("Other.work") == T["CLIENTS"]
    assert uses["other/unrelated.py", "direct"] == {("flow", "start_it")} and uses["other/unrelated.py", "elsewhere"] == T["ORDERS_CORE"]


def test_long_chains_and_cycles(spark):
    chain = [(f"m{k}.py", f"from m{k - 1} import t\n" if k else 't = Table("far", m)\n') for k in range(25)]
    cycle = [("a.py", "from b import x\ndef f():\n    y = x\n    x2 = y\n    y = x2\n    return y.c.z\n"), ("b.py", "from a import x\n")]
    files = spark.createDataFrame([*chain, ("use.py", "from m24 import t\ndef f():\n    return t.c.a\n"), *cycle], "path string, content string")
    assert [tuple(r) for r in function_uses(call_facts(files), known_tables(files)).collect()] == [("use.py", "f", "table", "FAR")]


def test_nothing(spark):
    files = spark.createDataFrame([], "path string, content string")
    assert function_uses(call_facts(files), known_tables(files), orm_classes(files)).count() == 0


ROUTERS = {
    "svc/main.py": "from fastapi import FastAPI\nfrom svc.api import api\napp = FastAPI()\napp.include_router(api, prefix='/v9')\n",
    "svc/api/__init__.py": "from .top import api\n",
    "svc/api/top.py": "from . import orders\nfrom .users import router as people\napi = APIRouter(prefix='/api')\napi.include_router(orders.router, prefix='/o')\napi.include_router(people)\napi.include_router(people, prefix='/again')\n",
    "svc/api/orders.py": "router = APIRouter(prefix='/orders')\n@router.get('/{id}')\ndef one(id): pass\n",
    "svc/api/users.py": "router = APIRouter()\n@router.post('/users')\ndef new(): pass\nalone = APIRouter(prefix='/alone')\n@alone.get('/x')\ndef x(): pass\n@unknown.get('/y')\ndef y(): pass\nrouter.include_router(router)\n",
}


def test_prefixes_of_routers(spark):
    files = spark.createDataFrame(list(ROUTERS.items()), "path string, content string")
    rows = backend_routes(files, routers=router_prefixes(call_facts(files))).collect()
    assert sorted((r["function"], r["route"]) for r in rows) == [("new", "/v9/api/again/users"), ("new", "/v9/api/users"), ("one", "/v9/api/o/orders/{id}"), ("x", "/alone/x"), ("y", "/y")]


def test_prefixes_of_paths(spark):
    rules = [
        PrefixRule("any", "", "/base"), PrefixRule("folder", "admin", "/admin"), PrefixRule("folder", "flows", "/flows"), PrefixRule("stem_contains", "book", "/books", "file"), PrefixRule("stem_contains", "bookings", "/never", "file"),
        PrefixRule("path_contains", "money", "/money", once=True), PrefixRule("stem", "tagsets", "/own", replaces=True),
    ]
    paths = {"flows/admin/x.py": "/base/admin/flows", "a/bookings.py": "/base/books", "money/b.py": "/base/money", "admin/tagsets.py": "/own", "adminx/y.py": "/base", "my_money/book.py": "/base/books/money"}
    got = {r["path"]: r["p"] for r in spark.createDataFrame([(p,) for p in paths], "path string").withColumn("p", path_prefix("path", rules)).collect()}
    assert got == paths
    assert {r["p"] for r in spark.createDataFrame([("a/b.py",)], "path string").withColumn("p", path_prefix("path", [("z", "/z"), ("b", "/b"), ("a", "/a")])).collect()} == {"/b"}
