"""What can be reached over edges, and levels of nodes."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.storage import stored


def reachable(edges: DataFrame, source: str, target: str, depth: int = 5) -> DataFrame:
    """source, target and the least number of steps between them, up to depth; cycles end where they began."""
    step = edges.select(F.col(source).alias("source"), F.col(target).alias("target")).where("source != target").distinct()
    found = frontier = stored(step.withColumn("steps", F.lit(1)), "closure")
    for n in range(2, depth + 1):
        onward = frontier.select("source", F.col("target").alias("_via")).join(step.select(F.col("source").alias("_via"), "target"), "_via")
        new = onward.select("source", "target").where("source != target").distinct().join(found, ["source", "target"], "left_anti")
        frontier = stored(new.withColumn("steps", F.lit(n)), "closure")
        if frontier.isEmpty():
            break
        found = found.unionByName(frontier)
    return found


#: Closures write what they have found anew after so many rounds, so that plans don't grow with the number of rounds.
ROUNDS = 16


def roots_and_levels(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Each node's level: the longest chain of edges that leads down from it, 0 for what depends on nothing; nodes on or above cycles have no level."""
    waiting = stored(edges.select(F.col(source).alias("node"), F.col(target).alias("below")).distinct(), "levels")
    nodes = waiting.select("node").unionByName(waiting.select(F.col("below").alias("node"))).distinct()
    done = new = stored(nodes.join(waiting.select("node"), "node", "left_anti").withColumn("level", F.lit(0)), "levels")
    for n in count(1):
        # edges to nodes of the last level are done with; a node follows once it has no other edge
        below = new.select(F.col("node").alias("below"))
        touched, waiting = waiting.join(below, "below", "left_semi").select("node").distinct(), stored(waiting.join(below, "below", "left_anti"), "levels")
        new = stored(touched.join(waiting.select("node"), "node", "left_anti").withColumn("level", F.lit(n)), "levels")
        if new.isEmpty():
            break
        done = done.unionByName(new)
        if n % ROUNDS == 0:
            done = stored(done, "levels")
    return nodes.join(done, "node", "left")
