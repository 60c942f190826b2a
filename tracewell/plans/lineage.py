"""Column lineage of views: scopes bound to what they read, followed to base tables, and emitted as rows."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewell.operators.aggregates import majority_source
from tracewell.operators.closure import ROUNDS
from tracewell.plans.sql_scopes import as_definitions, scopes_of
from tracewell.storage import spread, stored

PLACE = ["object", "scope", "branch"]


#: How sure an edge is, surest first. The last holds for sources that were voted for.
RULES = ("constant", "qualified", "known_column", "only_source", "wildcard", "first_from", "first_join", "last_join", "cte_vote")
#: Of several sources that may have an unqualified column: the FROM first, the JOIN that comes first, or the JOIN that comes last (FROM only without a JOIN).
FALLBACKS = ("first_from", "first_join", "last_join")


def _rank(rule: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, RULES)), rule).cast("int")


def _precedence(fallback: str) -> Column:
    """Small for the source that the rule prefers, of those with a position (0 is the FROM)."""
    place = F.col("position")
    return {"first_from": place, "first_join": F.when(place == 0, F.lit(1 << 30)).otherwise(place), "last_join": -place}[fallback]


def bind(items: DataFrame, sources: DataFrame, catalog: DataFrame | None = None, fallback: str = "first_from") -> DataFrame:
    """lineage_edge: one row for each reference of each item, bound to a source of its SELECT, with the rule that bound it; items without references keep one row.

    A qualified reference goes to the source of that alias. An unqualified one goes to the source that is known to have
    the column (a scope that puts it out, or a table of the catalog), or to the only source, else to one that may have
    it: a table rather than a scope, and of several the one that fallback (of FALLBACKS) prefers.
    """
    if fallback not in FALLBACKS:
        raise ValueError(f"fallback must be one of {FALLBACKS}")
    refs = items.select(*PLACE, "ordinal", "out_col", "expr", "direct", "excluded", F.explode_outer("refs").alias("ref")).select("*", F.col("ref.qualifier").alias("qualifier"), F.col("ref.col").alias("src_col")).drop("ref")
    puts = items.select("object", F.col("scope").alias("target"), F.col("out_col").alias("src_col")).distinct().withColumn("puts", F.lit(True))
    # aliases with # are queries inside expressions: only their own reference leads to them
    n_plain = sources.where(~F.col("alias").startswith("#")).groupBy(*PLACE).agg(F.count("*").alias("n_sources"))
    pairs = refs.where("src_col is not null").join(spread(sources), PLACE).where((F.col("qualifier").isNull() & ~F.col("alias").startswith("#")) | (F.col("qualifier") == F.col("alias")))
    pairs = pairs.join(spread(n_plain), PLACE, "left").join(spread(puts), ["object", "target", "src_col"], "left")
    sure = F.col("puts").isNotNull()
    if catalog is not None:
        known = catalog.select(F.lower(F.split_part("table_name", F.lit("."), F.lit(-1))).alias("_table"), F.lower("column_names").alias("_column")).distinct().withColumn("known", F.lit(True))
        pairs = pairs.join(known, (F.lower(F.split_part("target", F.lit("."), F.lit(-1))) == F.col("_table")) & (F.col("src_col") == F.col("_column")) & (F.col("kind") == "base"), "left")
        sure = sure | F.col("known").isNotNull()
    rule = F.when(F.col("src_col") == "*", "wildcard").when(F.col("qualifier").isNotNull(), "qualified").when(sure, "known_column").when(F.col("n_sources") == 1, "only_source").otherwise(fallback)
    pairs = pairs.withColumn("rule", rule)
    score = F.when(F.col("rule") == "known_column", 0).when(F.col("kind") == "base", 1).otherwise(2)
    preferred = F.when(F.col("rule") == fallback, _precedence(fallback)).otherwise(F.col("position"))
    key = [*PLACE, "ordinal", "out_col", "expr", "direct", "excluded", "qualifier", "src_col"]
    stars = pairs.where("rule = 'wildcard'").select(*key, "kind", "target", "rule", "position")
    one = pairs.where("rule != 'wildcard'").groupBy(*key).agg(F.min(F.struct(score.alias("score"), preferred.alias("preferred"), "position", "kind", "target", "rule")).alias("b")).select(*key, "b.kind", "b.target", "b.rule", "b.position")
    none = refs.where("src_col is null").select(*key, F.lit("none").alias("kind"), F.lit(None).cast("string").alias("target"), F.lit("constant").alias("rule"), F.lit(0).alias("position"))
    return stars.unionByName(one).unionByName(none).withColumnsRenamed({"kind": "src_kind", "target": "src_name"})


def follow(frontier: DataFrame, items: DataFrame, edges: DataFrame) -> DataFrame:
    """The base columns behind asked columns: object, column, position, direct, expr, src_name, src_col, and the rank of the least sure rule on the way.

    frontier: object, column, position, scope, asked, direct, expr, rank. Scopes are followed however long their chain is;
    what has been asked of a scope before isn't asked again, which ends cycles.
    """
    frontier = stored(frontier.distinct(), "lineage-frontier")
    named = items.where("out_col != '*'").select("object", "scope", F.col("out_col").alias("asked")).distinct()
    gives = spread(named.select("object", F.col("scope").alias("src_name"), F.col("asked").alias("src_col")).withColumn("gives", F.lit(True)))
    star_in = items.where("out_col = '*'").select("object", F.col("scope").alias("src_name")).distinct().withColumn("passes", F.lit(True))
    e = edges.select("object", "scope", "branch", "out_col", "excluded", F.col("expr").alias("e_expr"), F.col("direct").alias("e_direct"), "src_kind", "src_name", "src_col", F.col("position").alias("e_position"), _rank(F.col("rule")).alias("e_rank"))
    # a name that a scope puts out leads to its own edges, be they none; only other names go by the scope's wildcards
    own = named.join(spread(e.where("out_col != '*'").withColumnRenamed("out_col", "asked").drop("branch", "excluded", "e_position").distinct()), ["object", "scope", "asked"], "left").withColumn("named", F.lit(True))
    wildcards = spread(e.where("out_col = '*'").join(spread(star_in), ["object", "src_name"], "left").withColumnRenamed("src_col", "star_col"))
    own, found, seen = spread(stored(own, "lineage-own")), None, frontier
    key = ["object", "column", "position", "direct", "expr", "rank"]
    for n in count(1):
        # the kinds of places that were asked here: their names, and what is left for wildcards
        asked = spread(frontier).join(own, ["object", "scope", "asked"], "left")
        way = {"direct": F.col("direct") & F.col("e_direct"), "expr": F.when(F.col("expr") != "", F.col("expr")).otherwise(F.col("e_expr")), "rank": F.greatest("rank", "e_rank")}
        plain = asked.where("src_kind is not null").withColumns(way | {"src_col": F.when(F.col("src_col") == "*", F.col("asked")).otherwise(F.col("src_col"))}).select(*key, "src_kind", "src_name", "src_col")
        passed = asked.where("named is null").select(*frontier.columns).join(wildcards, ["object", "scope"]).where(~F.array_contains("excluded", F.col("asked")))
        passed = passed.withColumns(way | {"src_col": F.when(F.col("star_col") == "*", F.col("asked")).otherwise(F.col("star_col"))}).join(gives, ["object", "src_name", "src_col"], "left")
        # of the sources of a wildcard, the first that has the column: a scope that names it, else a table, else a scope with a wildcard
        order = F.when(F.col("gives").isNotNull(), 0).when(F.col("src_kind") == "base", 1).when(F.col("passes").isNotNull(), 2).otherwise(3)
        wild = passed.groupBy(*key, "scope", "branch", "src_col").agg(F.min(F.struct(order.alias("order"), "e_position", "src_kind", "src_name")).alias("b")).select(*key, "b.src_kind", "b.src_name", "src_col")
        step = stored(plain.unionByName(wild).distinct(), "lineage")
        ends = step.where("src_kind != 'scope'").drop("src_kind")
        found = ends if found is None else found.unionByName(ends)
        onward = step.where("src_kind = 'scope'").select("object", "column", "position", F.col("src_name").alias("scope"), F.col("src_col").alias("asked"), "direct", "expr", "rank").distinct()
        before = spread(seen).alias("before")
        new = onward.alias("new").join(before, [F.col(f"new.{c}").eqNullSafe(F.col(f"before.{c}")) for c in onward.columns], "left_anti")
        frontier = stored(new, "lineage-frontier")
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
        if n % ROUNDS == 0:
            found, seen = stored(found.distinct(), "lineage"), stored(seen, "lineage-seen")
    return found.distinct()


def resolve(objects: DataFrame, items: DataFrame, edges: DataFrame) -> DataFrame:
    """Each column of each object with the base columns that it comes from: object, column, position, direct, expr, src_name, src_col, rank.

    Columns that the main query doesn't lead to go to the first scope that puts out more than half of such columns of
    their object, if there is one.
    """
    columns = objects.where("status = 'OK'").select("object", F.posexplode("columns").alias("position", "column"))
    first = items.where("scope = 'main' and branch = 0").groupBy("object").agg(F.max(F.col("out_col") == "*").alias("starred"), F.count("*").alias("width"))
    placed = columns.join(spread(first), "object")
    by_place = placed.where("not starred and position < width").join(spread(items.where("scope = 'main'").select("object", F.col("ordinal").alias("position"), F.col("out_col").alias("asked")).distinct()), ["object", "position"])
    by_name = placed.where("starred").withColumn("asked", F.lower("column"))
    start = by_place.select("object", "column", "position", "asked").unionByName(by_name.select("object", "column", "position", "asked"))
    ask = lambda df, scope, rank: df.select("object", "column", "position", F.col(scope).alias("scope") if scope != "main" else F.lit("main").alias("scope"), "asked", F.lit(True).alias("direct"), F.lit("").alias("expr"), rank.alias("rank"))
    found = stored(follow(ask(start, "main", F.lit(0)), items, edges), "lineage-found")
    missing = columns.join(spread(found.select("object", "column").distinct()), ["object", "column"], "left_anti").withColumn("asked", F.lower("column"))
    missing = stored(missing, "lineage-missing")
    if missing.isEmpty():
        return found
    scopes = items.where("scope != 'main' and out_col != '*'").groupBy("object", "scope", F.col("out_col").alias("asked")).agg(F.min("place").alias("place"))
    scopes = scopes.withColumn("place", F.min("place").over(Window.partitionBy("object", "scope")))
    voted = majority_source(missing.select("object", "asked"), scopes, ["object"], "asked", "scope", "place").withColumnRenamed("scope", "voted")
    asked = missing.join(spread(voted), "object").join(spread(scopes.select("object", F.col("scope").alias("voted"), "asked")), ["object", "voted", "asked"])
    return found.unionByName(follow(ask(asked, "voted", _rank(F.lit("cte_vote"))), items, edges))


def emit(objects: DataFrame, resolved: DataFrame, drop_unknown: bool = False) -> DataFrame:
    """The six-column relation: a row for each object column, or one status row for an object that couldn't be read."""
    wanted = objects.where("status = 'OK'").select("object", F.posexplode("columns").alias("position", "column"))
    wanted = wanted.groupBy("object", "column").agg(F.min("position").alias("position"))
    per = resolved.groupBy("object", "column", "position").agg(
        F.array_sort(F.collect_set("src_name")).alias("tables"),
        F.array_sort(F.collect_set(F.upper("src_col"))).alias("cols"),
        F.min("direct").alias("direct"),
        F.coalesce(F.min(F.when(F.col("expr") != "", F.col("expr"))), F.lit("")).alias("expr"),
    )
    rows = wanted.join(spread(per), ["object", "column", "position"], "left")
    constant = F.size("tables") == 0
    derived = ~F.col("direct") | (F.size("tables") > 1) | (F.size("cols") > 1)
    lineage = rows.select(
        F.col("object").alias("view_name"),
        F.upper("column").alias("view_column"),
        F.when(F.col("tables").isNull(), "UNKNOWN").when(derived, "DERIVED").otherwise("DIRECT").alias("column_type"),
        F.when(F.col("tables").isNull(), "UNKNOWN").when(constant, "CALCULATED").otherwise(F.array_join("tables", "; ")).alias("source_table"),
        F.when(F.col("tables").isNull(), "UNKNOWN").when(constant, F.col("expr")).otherwise(F.array_join("cols", "; ")).alias("source_column"),
        F.coalesce("expr", F.lit("")).alias("expression_type"),
    )
    if drop_unknown:
        lineage = lineage.where("column_type != 'UNKNOWN'")
    error = F.lit("ERROR")
    failed = objects.where("status != 'OK'").select(F.col("object").alias("view_name"), error.alias("view_column"), error.alias("column_type"), F.col("status").alias("source_table"), F.col("status").alias("source_column"), error.alias("expression_type"))
    return lineage.unionByName(failed)


def resolved_columns(spark: SparkSession, definitions: DataFrame | Iterable[tuple[str, str | None]], catalog: DataFrame | None = None, fallback: str = "first_from") -> tuple[DataFrame, DataFrame]:
    """The objects that definitions (name, ddl) are, and what resolve() finds of them."""
    read = stored(scopes_of(as_definitions(spark, definitions)), "scopes")
    objects = read.drop("items", "sources")
    items = read.select("object", F.posexplode("items").alias("place", "i")).select("object", "place", "i.*")
    sources = read.select("object", F.explode("sources").alias("s")).select("object", "s.*")
    edges = stored(bind(items, sources, catalog, fallback), "lineage-edges")  # every step of the closure reads them
    return objects, resolve(objects, items, edges)


def view_lineage(spark: SparkSession, definitions: DataFrame | Iterable[tuple[str, str | None]], catalog: DataFrame | None = None, fallback: str = "first_from", drop_unknown: bool = False) -> DataFrame:
    """VIEW_TO_SOURCE_COLUMN_LINEAGE of definitions (name, ddl); catalog (table_name, column_names) settles unqualified names, fallback what it leaves open."""
    return emit(*resolved_columns(spark, definitions, catalog, fallback), drop_unknown=drop_unknown)


def lineage_rules(spark: SparkSession, definitions: DataFrame | Iterable[tuple[str, str | None]], catalog: DataFrame | None = None, fallback: str = "first_from") -> DataFrame:
    """view_name, view_column, source_table, source_column and rule: of all ways from a column to a source the surest, which is as sure as its least sure step."""
    _, found = resolved_columns(spark, definitions, catalog, fallback)
    rows = found.where("src_name is not null").groupBy("object", F.upper("column").alias("view_column"), "src_name", F.upper("src_col").alias("source_column")).agg(F.min("rank").alias("rank"))
    return rows.select(F.col("object").alias("view_name"), "view_column", F.col("src_name").alias("source_table"), "source_column", F.get(F.array(*map(F.lit, RULES)), F.col("rank") - 1).alias("rule"))


def success_rate(lineage: DataFrame) -> DataFrame:
    """The share of rows that are neither errors nor unknown, in percent."""
    return lineage.agg(F.count("*").alias("n_rows"), F.countDistinct("view_name").alias("n_views"), F.coalesce(100 * F.avg(F.when(F.col("column_type").isin("ERROR", "UNKNOWN"), 0.0).otherwise(1.0)), F.lit(0.0)).alias("success_percent"))
