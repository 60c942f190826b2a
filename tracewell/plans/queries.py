"""The registered queries of the library's own operators, over the driver's tables, and their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.functions.names import camel_to_snake, last_part, name_parts, normal_url, object_name, object_url, segment_similarity
from tracewell.functions.predicates import any_column_contains, likely_table, looks_like_sql, procedure_name, table_candidate
from tracewell.operators.aggregates import column_count, consolidate, duplicates, list_distinct, percentages, token_counts, value_counts
from tracewell.operators.closure import reachable, roots_and_levels
from tracewell.operators.delimited import explode_list, explode_table_columns, table_columns_text, without_alias
from tracewell.operators.joins import contained_names, enclosing_range, last_wins, match_routes, remaining, suffix_join, wildcard_column_join, word_references
from tracewell.operators.ranking import best_of, in_groups, numbered
from tracewell.plans.relations import action_table_columns, action_tables, procedure_triggers

QUERIES = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


PART_NAMES = "(SELECT p_name AS table_name, min(p_partkey) AS k FROM part GROUP BY 1)"
PART_COLUMNS = "(SELECT p_name AS table_name, p_brand AS column_names, min(p_partkey) AS k FROM part GROUP BY 1, 2)"


def part_names(spark, d):
    return table(spark, d, "part").groupBy(F.col("p_name").alias("table_name")).agg(F.min("p_partkey").cast("int").alias("base_primary_id"))


def part_columns(spark, d):
    return table(spark, d, "part").groupBy(F.col("p_name").alias("table_name"), F.col("p_brand").alias("column_names")).agg(F.min("p_partkey").cast("int").alias("primary_key"))


def order_details(spark, d):
    """Orders with `NAME:[brand,...];...` of what they hold."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return table_columns_text(lines.select(F.col("l_orderkey").alias("orderkey"), F.upper("p_name").alias("name"), "p_brand"), ["orderkey"], "name", "p_brand")


@query(f"""
WITH rows AS (SELECT DISTINCT l_orderkey AS orderkey, upper(p_name) AS table_name, p_brand AS column_name FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT row_number() OVER (ORDER BY orderkey, r.table_name, column_name) AS id, orderkey, r.table_name, column_name, CAST(n.k AS INTEGER) AS table_key, CAST(c.k AS INTEGER) AS column_key
FROM rows r LEFT JOIN {PART_NAMES} n ON upper(r.table_name) = upper(n.table_name)
LEFT JOIN {PART_COLUMNS} c ON upper(r.table_name) = upper(c.table_name) AND upper(column_name) = upper(c.column_names)""")
def action_columns_by_order(spark, d):
    """REL-01: delimited details taken apart, two keyed left joins, numbering."""
    details = order_details(spark, d).withColumn("x", F.lit(0))
    rows = action_table_columns(details, part_names(spark, d), part_columns(spark, d), keep=["orderkey", "x"])
    return rows.drop("x")


@query("""
WITH rows AS (SELECT r_name AS region, n_name AS table_name FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT row_number() OVER (ORDER BY region, r.table_name) AS id, region, r.table_name, n_nationkey AS table_key
FROM rows r LEFT JOIN nation n ON upper(n.n_name) = upper(r.table_name)""")
def action_tables_keyed(spark, d):
    """REL-01c/d: a table list taken apart, keyed and numbered."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    lists = n.groupBy(F.col("r_name").alias("region")).agg(list_distinct("n_name").alias("database_tables")).withColumn("x", F.lit(0))
    names = table(spark, d, "nation").select(F.col("n_nationkey").alias("base_primary_id"), F.col("n_name").alias("table_name"))
    return action_tables(lists, names, keep=["region", "x"]).drop("x")


@query("""
SELECT c_custkey, c_mktsegment || '.' || c_name AS source_table_full, c_name AS source_table, c_mktsegment AS base_schema FROM customer""")
def lineage_source_parts(spark, d):
    """REL-02: `DB.SCHEMA.TABLE AS x` less its alias, and its parts."""
    c = table(spark, d, "customer").select("c_custkey", F.concat_ws(".", "c_mktsegment", "c_name").alias("full"))
    c = c.withColumn("source", F.concat("full", F.lit(" as X1 "))).withColumn("source_table_full", without_alias("source"))
    p = name_parts("source_table_full")
    return c.select("c_custkey", "source_table_full", p["table"].alias("source_table"), p["schema"].alias("base_schema"))


@query("""
WITH a AS (SELECT CASE WHEN n_nationkey % 3 = 0 THEN lower(n_name) ELSE r_name || '.' || n_name END AS a_name FROM nation JOIN region ON n_regionkey = r_regionkey),
b AS (SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN r_name || '.' || n_name ELSE n_name END AS b_name FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT a_name, b_name, n_nationkey FROM a LEFT JOIN b ON upper(a_name) = upper(b_name) OR upper(a_name) = upper(split_part(b_name, '.', -1)) OR upper(split_part(a_name, '.', -1)) = upper(b_name)""")
def suffix_or_join(spark, d):
    """JOIN-03, REL-04: three alternatives of equality as one equi join."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    dotted = F.concat_ws(".", "r_name", "n_name")
    a = n.select(F.when(F.col("n_nationkey") % 3 == 0, F.lower("n_name")).otherwise(dotted).alias("a_name"))
    b = n.select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, dotted).otherwise(F.col("n_name")).alias("b_name"))
    return suffix_join(a, b, "a_name", "b_name")


@query("""
WITH a AS (SELECT n_nationkey AS a_key, n_name AS a_name, CASE WHEN n_regionkey < 2 THEN 'BASE TABLE' ELSE 'VIEW' END AS type FROM nation),
b AS (SELECT n_nationkey AS b_key, r_name || '.' || n_name AS b_name FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT a_key, a_name, type, b_key FROM a LEFT JOIN b ON (a_name = b_name OR a_name = split_part(b_name, '.', -1)) AND type = 'BASE TABLE'""")
def typed_suffix_join(spark, d):
    """JOIN-04, REL-03: case-sensitive, for rows of one type only."""
    n = table(spark, d, "nation")
    a = n.select(F.col("n_nationkey").alias("a_key"), F.col("n_name").alias("a_name"), F.when(F.col("n_regionkey") < 2, "BASE TABLE").otherwise("VIEW").alias("type"))
    b = n.join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("b_key"), F.concat_ws(".", "r_name", "n_name").alias("b_name"))
    return suffix_join(a, b, "a_name", "b_name", case_sensitive=True, both_ways=False, when=a["type"] == "BASE TABLE").select("a_key", "a_name", "type", "b_key")


@query("""
WITH a AS (SELECT p_partkey, upper(p_name) AS t, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN ' ' ELSE lower(p_brand) END AS c FROM part),
b AS (SELECT DISTINCT p_name, p_type, p_brand FROM part WHERE p_size < 5)
SELECT p_partkey, t, c, p_type, p_brand FROM a LEFT JOIN b ON upper(trim(t)) = upper(trim(p_name)) AND (c IS NULL OR trim(c) = '' OR upper(trim(c)) = upper(trim(p_brand)))""")
def wildcard_columns(spark, d):
    """JOIN-05, REL-06: a blank column stands for all."""
    p = table(spark, d, "part")
    c = F.when(F.col("p_partkey") % 5 == 0, None).when(F.col("p_partkey") % 5 == 1, " ").otherwise(F.lower("p_brand"))
    a = p.select("p_partkey", F.upper("p_name").alias("t"), c.alias("c"))
    b = p.where("p_size < 5").select("p_name", "p_type", "p_brand").distinct()
    return wildcard_column_join(a, b, "t", "c", "p_name", "p_brand").select("p_partkey", "t", "c", "p_type", "p_brand")


@query("""
WITH sp AS (SELECT c_name AS sp_name, c_mktsegment AS sp_schema, c_custkey FROM customer),
flows AS (SELECT c_name AS f, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS repos FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P' GROUP BY 1),
api AS (SELECT upper(c_name) AS s, string_agg(DISTINCT '/' || event_type, ',' ORDER BY '/' || event_type) AS routes FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'error' OR value > 90 GROUP BY 1)
SELECT row_number() OVER (ORDER BY sp_name) AS id, sp_name, sp_schema,
CASE WHEN f IS NOT NULL AND s IS NOT NULL THEN 'flow_triggered,api_triggered' WHEN f IS NOT NULL THEN 'flow_triggered' WHEN s IS NOT NULL THEN 'api_triggered' ELSE '' END AS trigger_type,
CASE WHEN f IS NOT NULL THEN repos WHEN s IS NOT NULL THEN routes END AS source_reference
FROM sp LEFT JOIN flows ON upper(sp_name) = upper(f) LEFT JOIN api ON upper(sp_name) = s""")
def trigger_classification(spark, d):
    """REL-05: procedures by what triggers them."""
    c = table(spark, d, "customer")
    null = lambda t: F.lit(None).cast(t)
    sp = c.select(F.col("c_name").alias("sp_name"), F.col("c_mktsegment").alias("sp_schema"), null("string").alias("table_name"), null("string").alias("column_name"), null("string").alias("relationship_types"), null("int").alias("base_table_id"), null("int").alias("base_column_id"))
    flows = table(spark, d, "orders").where("o_orderstatus = 'P'").join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_name").alias("sp_name"), F.col("o_orderpriority").alias("repo_name"))
    actions = table(spark, d, "events").where("event_type = 'error' OR value > 90").join(c, F.col("user_id") == F.col("c_custkey")).select(F.concat(F.lit("Names."), "c_name", F.lit(",NULL, IDENTIFIER")).alias("stored_procedures"), F.concat(F.lit("/"), "event_type").alias("backend_route"))
    return procedure_triggers(sp, flows, actions, prefix="Names.").select("id", "sp_name", "sp_schema", "trigger_type", "source_reference")


@query("SELECT upper(p_name) AS name, arg_max(p_brand, p_partkey) AS p_brand FROM part GROUP BY 1")
def last_wins_lookup(spark, d):
    """JOIN-08: of repeated keys, the last row's value."""
    return last_wins(table(spark, d, "part").select(F.upper("p_name").alias("name"), "p_brand", "p_partkey"), "name", "p_brand", "p_partkey")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def resume_anti_join(spark, d):
    """JOIN-10, SET-03: what is left to do."""
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    done = table(spark, d, "orders").where("o_orderstatus = 'P'").select("o_custkey").distinct().join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.lower("c_name").alias("c_name"))
    return remaining(c, done, "c_name")


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def unreferenced_except(spark, d):
    """SET-03 as a set difference."""
    return table(spark, d, "customer").select("c_custkey").subtract(table(spark, d, "orders").where("o_orderstatus = 'P'").select("o_custkey"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN (SELECT upper(x) FROM (VALUES ('building'), ('MACHINERY')) t(x))")
def allow_list(spark, d):
    """FLT-05: semi join to a list."""
    names = spark.createDataFrame([("building",), ("MACHINERY",)], "x string").select(F.upper("x").alias("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", "c_mktsegment").join(names, "c_mktsegment", "left_semi").select("c_custkey", "c_mktsegment")


@query("""SELECT o_custkey, string_agg(DISTINCT t, ',' ORDER BY t) AS tokens FROM (SELECT o_custkey, o_orderstatus AS t FROM orders UNION ALL SELECT o_custkey, o_orderpriority FROM orders) GROUP BY 1""")
def relationship_consolidate(spark, d):
    """AGG-03: token lists united by key."""
    return consolidate(table(spark, d, "orders").select("o_custkey", F.concat_ws(",", "o_orderstatus", "o_orderpriority").alias("tokens")), ["o_custkey"], "tokens")


@query("SELECT t AS token, count(*) AS n FROM (SELECT o_orderstatus AS t FROM orders UNION ALL SELECT o_orderpriority FROM orders) GROUP BY 1")
def token_distribution(spark, d):
    """AGG-12."""
    return token_counts(table(spark, d, "orders").select(F.concat_ws(", ", "o_orderstatus", "o_orderpriority").alias("tokens")), "tokens")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def event_counts(spark, d):
    """AGG-05."""
    return value_counts(table(spark, d, "events"), "event_type")


@query("SELECT p_name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def duplicate_names(spark, d):
    """AGG-09."""
    return duplicates(table(spark, d, "part"), "p_name")


@query("SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types FROM events")
def distinct_counts(spark, d):
    """AGG-06."""
    return table(spark, d, "events").agg(F.countDistinct("user_id").alias("users"), F.countDistinct("event_type").alias("types"))


@query("""SELECT count(*) AS total, count(*) FILTER (event_type = 'error') AS errors, round(100.0 * count(*) FILTER (event_type = 'error') / count(*), 1) AS errors_percent FROM events""")
def error_percentages(spark, d):
    """AGG-07/08."""
    return percentages(table(spark, d, "events"), errors=F.col("event_type") == "error")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10")
def top_customers(spark, d):
    """TOP-01: a report of the ten most frequent."""
    return value_counts(table(spark, d, "orders"), "o_custkey").limit(10)


@query("""
WITH c AS (SELECT c_mktsegment, c_nationkey, n_regionkey, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3)
SELECT c_mktsegment, n_regionkey, c_nationkey FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY CASE n_regionkey WHEN 2 THEN 0 WHEN 0 THEN 1 ELSE 2 END, n DESC, c_nationkey) AS r FROM c) WHERE r = 1""")
def priority_choice(spark, d):
    """SRC-10, WIN-04: the best candidate of each group, by a priority list."""
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("c_mktsegment", "c_nationkey", "n_regionkey").agg(F.count("*").alias("n"))
    tier = F.when(F.col("n_regionkey") == 2, 0).when(F.col("n_regionkey") == 0, 1).otherwise(2)
    return best_of(c, ["c_mktsegment"], tier, -F.col("n"), F.col("c_nationkey")).select("c_mktsegment", "n_regionkey", "c_nationkey")


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders")
def rank_in_groups(spark, d):
    """WIN-04 with all ranks."""
    return in_groups(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "rank", ["o_custkey"], F.desc("o_totalprice"), F.col("o_orderkey")).drop("o_totalprice")


@query("SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS id, o_orderkey FROM orders")
def global_numbering(spark, d):
    """WIN-01 without a single task for the whole table."""
    return numbered(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "id", F.desc("o_totalprice"), F.col("o_orderkey")).drop("o_totalprice")


@query("SELECT * FROM part WHERE lower(concat_ws(' ', p_partkey, p_name, p_brand, p_type, p_size)) LIKE '%widget brand#1%'")
def search_all_columns(spark, d):
    """FLT-07: a term that may span neighbouring columns."""
    return table(spark, d, "part").where(any_column_contains(["p_partkey", "p_name", "p_brand", "p_type", "p_size"], "Widget BRAND#1"))


VOCABULARY = ["and", "the", "de", "und", "tion", "que", "der", "est", "of the", "erly-in"]


@query(f"""SELECT doc_id, w FROM documents, (SELECT unnest({VOCABULARY!r}) AS w) v WHERE regexp_matches(lower(text), '\\b' || w || '\\b')""")
def word_references_in_documents(spark, d):
    """JOIN-11/12: whole words found by an equi join on distinct words."""
    names = spark.createDataFrame([(w,) for w in VOCABULARY], "w string")
    return word_references(table(spark, d, "documents").select("doc_id", "text"), names, "text", "w")


@query("SELECT page_id, p_name FROM pages, (SELECT DISTINCT 'example.' || CASE p_size % 3 WHEN 0 THEN 'com' WHEN 1 THEN 'net' ELSE 'org' END || '/' || CASE p_size % 2 WHEN 0 THEN 'en' ELSE 'fr' END AS p_name FROM part) WHERE contains(url, p_name)")
def contained_names_in_urls(spark, d):
    """JOIN-13: substrings found by an equi join on the rarest three characters of each name."""
    host = F.concat(F.lit("example."), F.when(F.col("p_size") % 3 == 0, "com").when(F.col("p_size") % 3 == 1, "net").otherwise("org"), F.lit("/"), F.when(F.col("p_size") % 2 == 0, "en").otherwise("fr"))
    names = table(spark, d, "part").select(host.alias("p_name")).distinct()
    return contained_names(table(spark, d, "pages").select("page_id", "url"), names, "url", "p_name").select("page_id", "p_name")


@query("""SELECT conv_id, turn, lo, hi FROM (SELECT c.conv_id, c.turn, r.lo, r.hi, row_number() OVER (PARTITION BY c.conv_id, c.turn ORDER BY r.place) AS n
FROM (SELECT DISTINCT conv_id, turn FROM conversations) c LEFT JOIN (SELECT DISTINCT conv_id, turn - 1 AS lo, turn + 2 AS hi, -turn AS place FROM conversations WHERE role = 'user' AND turn > 1) r ON c.conv_id = r.conv_id AND c.turn BETWEEN r.lo AND r.hi) WHERE n = 1""")
def line_in_range(spark, d):
    """JOIN-14: points with the first range that holds them."""
    c = table(spark, d, "conversations")
    ranges = c.where("role = 'user' AND turn > 1").select("conv_id", (F.col("turn") - 1).alias("lo"), (F.col("turn") + 2).alias("hi"), (-F.col("turn")).alias("place")).distinct()
    return enclosing_range(c.select("conv_id", "turn").distinct(), ranges, "conv_id", "turn", "lo", "hi", "place", width=2).select("conv_id", "turn", "lo", "hi")


ROUTES = """calls AS (SELECT DISTINCT 'GET' AS method, regexp_replace(url, '^https?://[^/]*', '') AS path FROM pages),
routes AS (SELECT 'GET' AS r_method, path AS r_path, row_number() OVER (ORDER BY path DESC) AS place FROM (SELECT DISTINCT regexp_replace(path, '[0-9]+[^/]*', '{id}') AS path FROM calls) UNION ALL SELECT 'POST', '/en/1', 1000000)"""


@query(f"""WITH {ROUTES}, x AS (SELECT *, list_distinct(string_split(path, '/')) AS a, list_distinct(string_split(r_path, '/')) AS b FROM calls JOIN routes ON method = r_method),
s AS (SELECT method, path, r_path, place, len(list_intersect(a, b)) * 1.0 / len(list_distinct(list_concat(a, b))) AS score, regexp_replace(trim(path, '/'), '\\{{[^{{}}/]*\\}}', '{{}}', 'g') = regexp_replace(trim(r_path, '/'), '\\{{[^{{}}/]*\\}}', '{{}}', 'g') AS exact FROM x),
b AS (SELECT *, row_number() OVER (PARTITION BY method, path ORDER BY exact DESC, CASE WHEN exact THEN 1 ELSE score END DESC, place) AS n FROM s WHERE exact OR score > 0.4)
SELECT c.method, c.path, b.r_path AS route FROM calls c LEFT JOIN b ON b.n = 1 AND c.method = b.method AND c.path = b.path""")
def route_matching(spark, d):
    """JOIN-15/16: exact routes first, then the most similar."""
    calls = table(spark, d, "pages").select(F.lit("GET").alias("method"), F.regexp_replace("url", "^https?://[^/]*", "").alias("path")).distinct()
    routes = calls.select(F.regexp_replace("path", "[0-9]+[^/]*", "{id}").alias("path")).distinct()
    routes = numbered(routes, "place", F.desc("path")).select(F.lit("GET").alias("method"), "path", "place").unionByName(spark.createDataFrame([("POST", "/en/1", 1_000_000)], "method string, path string, place long"))
    return match_routes(calls, routes, "path", "path", "method", "place", threshold=0.4).select("method", "path", F.col("route_path").alias("route"))


@query("""SELECT page_id, '/api/v1/' || lower(split_part(url, '/', 4)) || '/{' || CASE WHEN page_id % 2 = 0 THEN 'userId' ELSE 'user_id' END || '}' AS route, len(list_intersect(list_distinct(string_split(url, '/')), list_distinct(string_split('https://a/en/b', '/')))) * 1.0 / len(list_distinct(list_concat(string_split(url, '/'), string_split('https://a/en/b', '/')))) AS similarity FROM pages""")
def url_templates(spark, d):
    """URL normalisation and segment similarity."""
    place = F.lower(F.split_part("url", F.lit("/"), F.lit(4)))
    template = F.concat(F.lit("${BASE_URL}/v1/"), place, F.when(F.col("page_id") % 2 == 0, "/${params.userId}").otherwise("/${userId}"), F.lit("?page=${p}"))
    return table(spark, d, "pages").select("page_id", normal_url(template, {"BASE_URL": "/api"}).alias("route"), segment_similarity("url", F.lit("https://a/en/b")).alias("similarity"))


@query("""SELECT c_custkey, 'market_segment_' || lower(c_mktsegment) AS snake, c_name AS last, split_part(c_name, '#', 1) || '...' AS short, 'https://h/#/pinboard/' || c_custkey AS link FROM customer""")
def name_functions(spark, d):
    """Scalar functions on names."""
    c = table(spark, d, "customer")
    upper = F.concat(F.lit("marketSegment"), F.initcap("c_mktsegment"))
    return c.select("c_custkey", camel_to_snake(upper).alias("snake"), last_part(F.concat_ws(".", F.lit("db"), F.lit("s"), "c_name")).alias("last"), F.replace(object_name(F.lit(None).cast("string"), F.col("c_name")), F.lit("Object "), F.lit("")).alias("short"), object_url(F.lit("https://h/api/rest/2.0/"), F.lit("LIVEBOARD"), F.col("c_custkey").cast("string")).alias("link"))


@query("""
WITH RECURSIVE e AS (SELECT r_name AS a, n_name AS b FROM nation JOIN region ON n_regionkey = r_regionkey UNION SELECT n_name, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
t(source, target, steps) AS (SELECT a, b, 1 FROM e UNION SELECT source, b, steps + 1 FROM t JOIN e ON target = a WHERE steps < 5)
SELECT source, target, CAST(min(steps) AS INTEGER) AS steps FROM t GROUP BY 1, 2""")
def call_closure(spark, d):
    """UDT-27: what is reached in up to five steps."""
    return reachable(_hierarchy(spark, d), "a", "b", 5)


@query("""
WITH e AS (SELECT r_name AS a, n_name AS b FROM nation JOIN region ON n_regionkey = r_regionkey UNION SELECT n_name, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
l0 AS (SELECT b AS node FROM e WHERE b NOT IN (SELECT a FROM e)), l1 AS (SELECT DISTINCT a AS node FROM e WHERE a NOT IN (SELECT a FROM e WHERE b NOT IN (SELECT node FROM l0)))
SELECT DISTINCT node, CASE WHEN node IN (SELECT node FROM l0) THEN 0 WHEN node IN (SELECT node FROM l1) THEN 1 ELSE 2 END AS level FROM (SELECT a AS node FROM e UNION SELECT b FROM e)""")
def dependency_levels(spark, d):
    """LIN-13: levels of a dependency graph."""
    return roots_and_levels(_hierarchy(spark, d), "a", "b")


def _hierarchy(spark, d):
    n = table(spark, d, "nation")
    up = n.join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("a"), F.col("n_name").alias("b"))
    return up.unionByName(table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("a"), F.col("s_name").alias("b")))


@query("""SELECT p_partkey, p_name IS NOT NULL AND length(upper(p_type)) >= 3 AS candidate, length(p_type) > 5 AND upper(p_type) = p_type AS likely, p_partkey % 2 = 0 AS sql, p_partkey % 4 <> 1 AS procedure FROM part""")
def name_predicates(spark, d):
    """FLT-08/09/10 and the stand-ins for procedures."""
    p = table(spark, d, "part")
    text = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("select x from "), "p_name")).otherwise(F.col("p_name"))
    sp = F.when(F.col("p_partkey") % 4 == 1, F.lit(" NULL ")).otherwise(F.col("p_name"))
    return p.select("p_partkey", table_candidate("p_type").alias("candidate"), likely_table("p_type").alias("likely"), looks_like_sql(text).alias("sql"), procedure_name(sp).alias("procedure"))


@query("""SELECT l_orderkey, count(DISTINCT l_linestatus) + count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY 1""")
def column_counts(spark, d):
    """AGG-15: columns in two kinds of lists."""
    lists = table(spark, d, "lineitem").groupBy("l_orderkey").agg(list_distinct("l_linestatus").alias("simple"), list_distinct(F.concat(F.lit("f."), "l_returnflag")).alias("nested"))
    return lists.select("l_orderkey", column_count("simple", "nested").cast("long").alias("n"))


@query("""SELECT l_orderkey, upper(p_name) AS table_name, p_brand AS column_name FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def details_round_trip(spark, d):
    """JOIN-07: a delimited string made and taken apart again."""
    return explode_table_columns(order_details(spark, d), "table_column_details").select(F.col("orderkey").alias("l_orderkey"), "table_name", "column_name")


@query("""SELECT c_nationkey, c_mktsegment AS segment FROM customer GROUP BY 1, 2""")
def list_round_trip(spark, d):
    """AGG-01 and JOIN-07: a list made and taken apart again."""
    lists = table(spark, d, "customer").groupBy("c_nationkey").agg(list_distinct("c_mktsegment", ";").alias("segments"))
    return explode_list(lists, "segments", "segment", ";").select("c_nationkey", "segment")
