"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents fall by hash into blocks of about block_words words. Its target (shares by weight, never over
most_repeats times what it has, the excess reshared) is met by whole passes over its blocks and one partial pass, in
which blocks are taken in permuted order and the last one is cut at the document that comes nearest to the target. The
source's draws of blocks are its exact quota. The tree hands the quotas to the output shards: a node that covers several
shards gives its left half a multivariate-hypergeometric sample of its counts, which is what dealing all draws in random
order would give it; leaves hold exact counts of each source. A shard then gets as many draws from the source's permuted
draws, disjoint from other shards', and its rows are shuffled among themselves.

Only one row for each source comes to the driver. The tree's first levels, TOP_NODES nodes at most, are split there; each
node below is a row of counts, which its task splits further. A node's random numbers depend on its shards and the seed
alone. Quotas are listed by place and joined to the draws by source and place, so no source is one task there. One task
orders a source's blocks (a few numbers each): at most MOST_BLOCKS, or SHARD_BLOCKS for each SHARD_WORDS words of the corpus.

Defined results: null text has size 0; a null source is a source, last in order; null doc_ids and repeated ids keep all
their rows, rows with one id being drawn together; sources without words have target 0; all draws depend on hashes of
ids and the seed alone, so that reruns agree; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewell.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
BLOCK_WORDS = 50_000
MOST_BLOCKS = 16_384  # of a source, or SHARD_BLOCKS for each shard where that is more; larger sources have larger blocks
LEAST_SHARDS = 64
SHARD_WORDS = 100_000_000
SHARD_BLOCKS = 8
TOP_NODES = 512
SEED = 11


def size_column() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[int], most_repeats: int = MOST_REPEATS) -> list[Fraction]:
    """Shares of the total by weight; none over most_repeats times its size, the excess reshared among the others."""
    left, found = Fraction(sum(sizes)), [Fraction(0)] * len(sizes)
    open_ = [i for i in range(len(sizes)) if sizes[i]]
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] > most_repeats * sizes[i] * total]
        for i in over or open_:
            found[i] = Fraction(most_repeats * sizes[i]) if over else left * weights[i] / total
        if not over:
            break
        left -= sum(found[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return found


def split_tree(counts: np.ndarray, first: int, shards: int, seed: int, most: int = 1) -> Iterator[tuple[int, int, np.ndarray]]:
    """The tree's nodes of at most `most` shards, in order: first shard, number of shards, counts by source."""
    todo = [(first, shards, counts)]
    while todo:
        first, shards, counts = todo.pop()
        if shards <= most:
            yield first, shards, counts
            continue
        left = shards // 2
        total = int(counts.sum())
        # the fuller shards, of which there are total % shards, go left first
        take = left * (total // shards) + min(left, total % shards)
        given = np.random.default_rng([seed, first, shards]).multivariate_hypergeometric(counts, take, method="marginals") if take else np.zeros_like(counts)
        todo += [(first + left, shards - left, counts - given), (first, left, given)]


def quota_ranges(spark: SparkSession, counts: np.ndarray, shards: int, seed: int, top: int = TOP_NODES) -> DataFrame:
    """range_k, shard, first and past: the places among a source's draws that each shard gets; empty ranges are left out."""
    rows, start = [], np.zeros_like(counts)
    for first, n, part in split_tree(counts, 0, shards, seed, most=-(-2 * shards // top)):
        rows.append((first, n, part.tolist(), start.tolist()))
        start = start + part

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node in batch.to_pylist():
                at = np.array(node["starts"], np.int64)
                for shard, _, part in split_tree(np.array(node["counts"], np.int64), node["node"], node["shards"], seed):
                    held = np.flatnonzero(part)
                    yield pa.record_batch([pa.array(held, pa.int32()), pa.array(np.full(len(held), shard), pa.int32()), pa.array(at[held], pa.int64()), pa.array((at + part)[held], pa.int64())], ["range_k", "shard", "first", "past"])
                    at = at + part

    nodes = spark.createDataFrame(rows, "node int, shards int, counts array<long>, starts array<long>")
    return nodes.mapInArrow(split, "range_k int, shard int, first long, past long")


DRAWS = "array<struct<epoch:int,shard:int>>"


def _turn(seed: int) -> Column:
    """A document's place in the cut block."""
    return F.xxhash64("doc_id", F.lit(seed))


def _block(seed: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.col("n_blocks")).cast("int")


def plan_draws(sizes: DataFrame, block_words: int = BLOCK_WORDS, shards: int | None = None, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """sizes: doc_id, source, size. Returns the sources (one row each) and, by source and block, its draws and where its partial draw is cut."""
    spark = sizes.sparkSession
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).orderBy(F.col("source").asc_nulls_last()).collect()  # one row for each source
    names, totals = [r["source"] for r in by_source], [r["source_size"] for r in by_source]
    shards = shards or max(LEAST_SHARDS, -(-sum(totals) // SHARD_WORDS))
    goal = targets(totals, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(totals))])
    n_blocks = [min(max(MOST_BLOCKS, SHARD_BLOCKS * shards), max(1, -(-t // block_words))) for t in totals]
    passes = [int(g // t) if t else 0 for g, t in zip(goal, totals, strict=True)]
    rest = [float(g - p * t) for g, p, t in zip(goal, passes, totals, strict=True)]
    source_rows = [(i, names[i], totals[i], float(goal[i]), n_blocks[i], passes[i], rest[i]) for i in range(len(names))]
    sources = spark.createDataFrame(source_rows, "k int, source string, source_size long, target double, n_blocks int, passes int, rest double")

    placed = sizes.join(sources, sizes["source"].eqNullSafe(sources["source"])).select("k", _block(seed).alias("block"), _turn(seed).alias("turn"), "size", "rest", "passes")
    blocks = placed.groupBy("k", "block", "rest", "passes").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("k").orderBy(F.xxhash64("k", "block", F.lit(seed + 2)), "block")
    blocks = blocks.withColumn("end", F.sum("words").over(order)).withColumn("missing", F.col("rest") - (F.col("end") - F.col("words")))
    # in the partial pass a block is taken whole, is cut, or is left
    whole = (F.col("missing") >= F.col("words")) & (F.col("words") > 0) & (F.col("rest") > 0)
    cut = (F.col("missing") > 0) & (F.col("missing") < F.col("words"))
    blocks = stored(blocks.select("k", "block", "passes", whole.alias("whole"), cut.alias("cut"), "missing"), "mix-blocks")
    in_turn = placed.join(blocks.where("cut").select("k", "block", "missing"), ["k", "block"]).groupBy("k", "block", "missing", "turn").agg(F.sum("size").alias("size"))
    until = F.sum("size").over(Window.partitionBy("k", "block").orderBy("turn"))
    cuts = in_turn.withColumn("middle", until - F.col("size") / 2).where(F.col("middle") <= F.col("missing")).groupBy("k", "block").agg(F.max("turn").alias("last_turn"))

    last = F.col("passes") + F.when(F.col("whole") | F.col("cut"), 0).otherwise(-1)  # -1: the block isn't drawn at all
    draws = blocks.withColumn("last", last).where("last >= 0").select("k", "block", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("epoch"), "passes", "cut")
    counted = {r["k"]: r["n"] for r in draws.groupBy("k").agg(F.count("*").alias("n")).collect()}
    ranges = quota_ranges(spark, np.array([counted.get(i, 0) for i in range(len(names))], np.int64), shards, seed)
    ranges = ranges.select("range_k", "shard", F.explode(F.sequence("first", F.col("past") - 1)).alias("place"))
    in_order = Window.partitionBy("k").orderBy(F.xxhash64("k", "block", "epoch", F.lit(seed + 3)), "block", "epoch")
    drawn = draws.withColumn("n", F.row_number().over(in_order).cast("long") - 1)
    drawn = drawn.join(ranges, (F.col("k") == F.col("range_k")) & (F.col("n") == F.col("place")))
    drawn = drawn.select("k", "block", F.struct("epoch", "shard", (F.col("cut") & (F.col("epoch") == F.col("passes"))).alias("partial")).alias("draw"))
    plan = drawn.groupBy("k", "block").agg(F.sort_array(F.collect_list("draw")).alias("all_draws"))  # most_repeats + 1 at most
    plan = plan.join(cuts, ["k", "block"], "left").select(F.col("k").alias("_k"), F.col("block").alias("_b"), "all_draws", "last_turn")
    return sources.withColumnRenamed("source", "_source"), stored(plan.coalesce(8), "mix-plan")


def with_draws(documents: DataFrame, sources: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """documents as the struct _row, with source_size, target, and the draws (epoch and shard) of each row."""
    rows = documents.select(F.struct(*(documents[c] for c in documents.columns)).alias("_row"), documents["doc_id"].alias("doc_id"), documents["source"].alias("source"))
    rows = rows.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select("_row", "source_size", "target", "k", _block(seed).alias("block"), _turn(seed).alias("turn"))
    rows = rows.join(plan, (F.col("k") == F.col("_k")) & (F.col("block") == F.col("_b")), "left")
    kept = F.filter("all_draws", lambda d: ~d["partial"] | F.coalesce(F.col("turn") <= F.col("last_turn"), F.lit(False)))
    mine = F.transform(F.coalesce(kept, F.array().cast("array<struct<epoch:int,shard:int,partial:boolean>>")), lambda d: F.struct(d["epoch"].alias("epoch"), d["shard"].alias("shard")))
    return rows.select("_row", "source_size", "target", mine.cast(DRAWS).alias("draws"))


def _sizes(documents: DataFrame) -> DataFrame:
    return stored(documents.select("doc_id", "source", size_column().alias("size")), "mix-sizes")


def taken(documents: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source_size, target, taken, and the shards that its draws are dealt to, a shard for each draw."""
    sizes = _sizes(documents)
    rows = with_draws(sizes, *plan_draws(sizes, seed=seed, **options), seed=seed)
    size = F.col("_row.size")
    return rows.select("_row.doc_id", size.alias("size"), "source_size", "target", (size * F.size("draws")).cast("long").alias("taken"), F.sort_array("draws.shard").alias("shards"))


def mix(documents: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The mix itself: the rows of documents, each as often as drawn, by shard and in random order in each shard."""
    rows = with_draws(documents, *plan_draws(_sizes(documents), seed=seed, **options), seed=seed)
    drawn = rows.select("_row", F.explode("draws").alias("_draw")).withColumn("_turn", F.xxhash64("_row.doc_id", "_draw.epoch", F.lit(seed + 4)))
    dealt = drawn.repartition(F.col("_draw.shard"), F.pmod("_turn", F.lit(4))).sortWithinPartitions("_draw.shard", "_turn")
    return dealt.select("_row.*")
