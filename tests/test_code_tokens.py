"""Functions and calls of code that isn't Python."""

import time

import pytest

from tracewell.plans.code import frontend_calls, functions, sql_strings
from tracewell.plans.code_tokens import Innermost, function_ranges, mask, pairs

TS = r"""
class Api {
  async load(id) { return client.get(`/a/${ids.map(x => `n${x}`)}/b`); }
  static make = async (x) => { return 1 };
}
function g() { // } client.get('/no') not code
  const s = "} client.get('/no')"; const re = /[}/]+/g;
  if (s) { return s }
}
client.post('/top');
o = {foo: function(){ return 2 }, bar: (a) => a + 1, baz(x) { return x }};
export const h = async (a: string, b = {c: 1}): Promise<X> => {
  const url = `/h/${a.b}`;
  await client.put(url, {x: 1});
};
const k = useCallback(async () => { client.get('/k-k') }, []);
const one = x => client['delete']('/one');
const n = (a + b) * 2;
call(function named() { client.get('/file', {responseType: 'blob'}) });
"""
OTHERS = {
    "java": ("class A { public static int f(int x) throws E { return g(x); }\n void run(int x) { new B(); if (x) {} }\n List<String> l(){ String s=\"}\"; return null; }\n}", [("f", 1, 1), ("run", 2, 2), ("l", 3, 3)]),
    "r": ("f1 = function(x) {\n a # }\n}\nf2 <- function(y) y + 1\nz\n", [("f1", 1, 3), ("f2", 4, 4)]),
    "scala": ("def a(x: Int)(y: Int): Int = {\n x }\n  def b = 3\ndef c[T](x: T) { println(\"}\")\n }", [("a", 1, 2), ("b", 3, 3), ("c", 4, 5)]),
    "sh": ("a() {\n echo \"}\" # }\n}\nfunction b {\n x ${y}\n}\n", [("a", 1, 3), ("b", 4, 6)]),
    "js": ("var o = {foo: function(){\n return 1\n}}\nlet p = async (a) =>\n  a + 1\nfunction q(){}", [("foo", 1, 3), ("p", 4, 5), ("q", 6, 6)]),
}


def test_functions_of_a_front_end():
    code, strings = mask(TS, "ts")
    found = {r.name for r in function_ranges(code, pairs(code), "ts")}
    assert found == {"load", "make", "g", "foo", "bar", "baz", "h", "k", "one", "named"} and len(code) == len(TS)
    assert [TS[a:b] for a, b in strings][:2] == ["`/a/${ids.map(x => `n${x}`)}/b`", "`n${x}`"]


@pytest.mark.parametrize("extension", OTHERS)
def test_ranges(spark, extension):
    content, want = OTHERS[extension]
    files = spark.createDataFrame([("p", extension, content), ("q", extension, None)], "path string, extension string, content string")
    assert [(r["function_name"], r["first_line"], r["last_line"]) for r in functions(files).orderBy("place").collect()] == want


def test_calls_belong_to_the_innermost_function(spark):
    files = spark.createDataFrame([("web/a.ts", TS)], "path string, content string")
    rows = {(r["function"], r["method"], r["url"]) for r in frontend_calls(files).collect()}
    assert {(f, m) for f, m, _ in rows} == {("load", "GET"), ("unknown", "POST"), ("h", "PUT"), ("k", "GET"), ("one", "DELETE")}
    assert ("unknown", "POST", "/top") in rows and ("h", "PUT", "/h/{b}") in rows


def test_variables_of_other_functions_are_not_seen(spark):
    content = "function a() { const u = '/one'; client.get(u); }\nfunction b() { client.get(u); }\nfunction c() { const u = '/three'; return () => { client.get(u); }; }\n"
    rows = frontend_calls(spark.createDataFrame([("a.ts", content)], "path string, content string")).collect()
    assert {(r["function"], r["url"]) for r in rows} == {("a", "/one"), ("c", "/three")}


def test_innermost_by_brute_force():
    code, _ = mask(TS * 3, "ts")
    ranges = function_ranges(code, pairs(code), "ts")
    place = Innermost(ranges)
    for at in range(len(code)):
        assert place(at) == max((r for r in ranges if r.begin <= at < r.end), key=lambda r: r.begin, default=None)


@pytest.mark.parametrize("big", ["{" * 200_000, "f(){" * 50_000 + "}" * 50_000, "`${" * 50_000, "x = (a) => " * 20_000, "a<b " * 50_000 + "(", "a : " * 50_000, "x = " * 50_000, "a(" * 50_000, "/" * 100_000])
def test_time_is_linear(big):
    began = time.time()
    code, _ = mask(big, "ts")
    Innermost(function_ranges(code, pairs(code), "ts"))
    assert time.time() - began < 20


def test_texts_that_are_sql(spark):
    files = [
        ("a.py", "py", 'x = 1\ndb.execute("SELECT COUNT(*) FROM BIG_TABLE WHERE X = 1 AND Y = 2")\ndb.run(f"DELETE FROM {schema}.OLD_ROWS WHERE AGE > {n} AND K = 1")\n'),
        ("b.ts", "ts", "// 'SELECT a FROM comments WHERE b = 1'\nq(`SELECT t.id FROM things t WHERE t.n = ${n} AND 1 = 1`);\n"),
        ("c.sql", "sql", "SELECT a, b FROM first_table WHERE a = 1;\n\nUPDATE second_table SET b = 2 WHERE a = 3;"),
        ("d.sh", "sh", "# \"SELECT x FROM comments\"\npsql -c \"SELECT x, y FROM from_shell WHERE x > 2\"\n"), ("e.py", "py", "def (:"), ("f.sql", "sql", None),
    ]
    got = {(r["path"], r["line"], r["sql"]) for r in sql_strings(spark.createDataFrame(files, "path string, extension string, content string")).collect()}
    assert {(p, k) for p, k, _ in got} == {("a.py", 2), ("a.py", 3), ("b.ts", 2), ("c.sql", 1), ("c.sql", 3), ("d.sh", 2)}
    assert ("a.py", 2, "SELECT COUNT(*) FROM BIG_TABLE WHERE X = 1 AND Y = 2") in got
