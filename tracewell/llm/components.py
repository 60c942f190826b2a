"""Connected components of an edge table by alternating large-star and small-star steps, in joins and aggregations only.

A key with a large share of the rows is split: join_hot() joins the rows of such keys, of which there can be few, by a
broadcast of a bounded number of rows, so that they stay where they are.

Defined results: loops and repeated edges add nothing; nodes without an edge to another node have no row; an empty edge
table gives no rows; edges with a null end are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import stored

#: Keys are hot from this number of rows and this share of all rows on, so that there are at most MOST_HOT of them.
HOT_ROWS = 1000
MOST_HOT = 5000


def join_hot(rows: DataFrame, by_key: DataFrame, key: str) -> DataFrame:
    """rows joined to by_key, which has one row for each key and its number of rows in n."""
    total = by_key.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") > max(HOT_ROWS, total // MOST_HOT)
    if by_key.where(hot).isEmpty():
        return rows.join(by_key, key)
    few = F.broadcast(by_key.where(hot))
    rest = rows.join(few.select(key), key, "left_anti").join(by_key.where(~hot), key)
    return rows.join(few, key).unionByName(rest)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """large: ties each larger neighbour to the smallest one; small: ties the smaller neighbours and the node itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    around = both if large else both.where("v < u")
    least = stored(around.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n"), "least")
    joined = join_hot(around, least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return stored(out.where("u != v").distinct(), "edges")


def connected_components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node that it reaches), for the nodes of edges (u, v). Each half round writes its edges to shared storage."""
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "edges", release=True)
    mark = _mark(now)
    while mark[0]:
        new = _star(_star(now, True), False)
        found = _mark(new)
        now, done, mark = new, found == mark, found
        if done:
            break
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
