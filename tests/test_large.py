"""What must hold for queries whose tables grow: no cut, no broadcast of what grows, and work dealt over tasks."""

import pytest
from pyspark.sql import functions as F

from tracewell.operators import ranking
from tracewell.operators.delimited import explode_table_columns, table_columns_text
from tracewell.plans import cases, lineage, queries, relation_queries
from tracewell.plans.procedures import profile, variables
from tracewell.plans.python_code import call_facts
from tracewell.plans.relations import repo_references
from tracewell.plans.sql_scopes import scopes_of
from tracewell.serve import Server


def test_served_rows_are_whole(spark, tmp_path):
    n = 10_050
    spark.range(n).select(F.col("id").alias("p_partkey"), F.lit("Brand#12").alias("p_brand"), F.lit(4).alias("p_size")).write.parquet(str(tmp_path / "part.parquet"))
    for name in ("supplier", "customer"):
        spark.range(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert relation_queries.served_rows(spark, str(tmp_path)).count() == n
    with pytest.raises(ValueError):  # what a client asks for keeps its limit
        Server({"BASE_NAMES": spark.range(1)}).query("base_names", n)


@pytest.fixture()
def parts(spark, tmp_path):
    """300 parts, customers and suppliers, each table in one small file, as DuckDB writes them."""
    n = spark.range(300).coalesce(1)
    n.select(F.col("id").alias("p_partkey"), (F.col("id") % 50).cast("int").alias("p_size")).write.parquet(str(tmp_path / "part.parquet"))
    n.select(F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey")).write.parquet(str(tmp_path / "customer.parquet"))
    n.select(F.col("id").alias("s_suppkey"), (F.col("id") % 25).cast("int").alias("s_nationkey")).write.parquet(str(tmp_path / "supplier.parquet"))
    return str(tmp_path)


def plans_of(monkeypatch, module, query) -> list[str]:
    """The plans of all that a query stores on its way, and its own."""
    found, store = [], module.stored
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(module, "stored", lambda df, *more: (found.append(plan(df)), store(df, *more))[1])
    last = plan(query())
    return [*found, last]


@pytest.mark.parametrize("name", ["view_lineage_cases", "lineage_rule_cases"])
def test_lineage_broadcasts_nothing(spark, parts, monkeypatch, name):
    plans = plans_of(monkeypatch, lineage, lambda: cases.QUERIES[name](spark, parts))
    assert len(plans) > 8 and not [p for p in plans if "Broadcast" in p]


def test_definitions_are_dealt(spark, parts):
    one = cases._views(spark, parts, [v for v, _ in cases.RULED]).coalesce(1)
    assert scopes_of(one).select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_procedures_are_dealt(spark, parts):
    one = cases._procedures(spark, parts).coalesce(1)
    assert variables(one).select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert profile(one).select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_files_are_dealt(spark, parts):
    one = cases._backend(spark, parts).coalesce(1)
    assert call_facts(one).select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_references_are_dealt(spark):
    """The rows that references become come from several tasks, though all name one table."""
    references = spark.range(40).coalesce(1).select(F.lit("r").alias("repo_name"), F.lit("f").alias("function_name"), F.lit("t").alias("table_name"), F.lit(None).cast("string").alias("column_name"), F.col("id").cast("string").alias("file_name"))
    base = spark.createDataFrame([(1, 1, "T", "A"), (2, 1, "T", "B")], "primary_key int, base_primary_id int, table_name string, column_names string")
    views = spark.createDataFrame([(5, "T", "X")], "primary_key int, view_name string, column_names string")
    got = repo_references(references, F.broadcast(base), F.broadcast(views))
    assert got.count() == 80 and got.select(F.spark_partition_id().alias("p")).distinct().count() > 1


@pytest.mark.parametrize("name", ["action_columns_by_schema", "action_columns_by_order"])
def test_rows_of_orders_are_made_once(spark, tmp_path, monkeypatch, name):
    """What is dealt by ranges is read twice, for a sample and for its rows, so details are taken apart and joined before; what numbers need is not shuffled to the rows."""
    spark.range(50).select(F.col("id").alias("p_partkey"), F.concat(F.lit("p"), F.col("id") % 7).alias("p_name"), F.concat(F.lit("B"), F.col("id") % 3).alias("p_brand"), F.lit("T").alias("p_type"), F.lit(4).alias("p_size")).write.parquet(str(tmp_path / "part.parquet"))
    spark.range(300).select((F.col("id") % 40).alias("l_orderkey"), (F.col("id") % 50).alias("l_partkey")).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt, last = plans_of(monkeypatch, ranking, lambda: queries.QUERIES[name](spark, str(tmp_path)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "rangepartitioning" in dealt and "Generate" not in dealt and "Join" not in dealt
    assert "BroadcastHashJoin" in last and "SortMergeJoin" not in last


def test_details_are_shuffled_once(spark):
    lines = spark.range(5000).select((F.col("id") % 600).alias("k"), F.concat(F.lit("T"), F.col("id") % 5).alias("t"), F.concat(F.lit("c"), F.col("id") % 3).alias("c")).repartition(3)
    text = table_columns_text(lines, ["k"], "t", "c")
    assert text._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, explode_table_columns(text, "table_column_details").select("k", "table_name", "column_name").collect())) == sorted(map(tuple, lines.distinct().collect()))


def test_details_without_columns(spark):
    rows = [(1, "A", "x"), (1, "A B", "y"), (1, "A", None), (1, "A", "w"), (1, "A", "x"), (2, "A", None), (2, "A", None), (2, "B", "c"), (2, "C", None), (3, None, "x"), (4, "A", "")]
    got = table_columns_text(spark.createDataFrame(rows, "k int, t string, c string"), ["k"], "t", "c").collect()
    assert {r["k"]: r["table_column_details"] for r in got} == {1: "A B:[y];A:[w,x]", 2: "A:[unknown];B:[c];C:[unknown]", 3: "", 4: "A:[]"}
