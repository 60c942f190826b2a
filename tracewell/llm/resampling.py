"""Importance resampling towards a target distribution of hashed n-grams.

Words are found in the UTF-8 bytes of Arrow's buffers without making strings: a table classes all bytes at once, the places
where the class changes, or a row begins or ends, are the bounds of words, and the CRC-32 of all words advance together,
one byte of each a step, through the usual table of 256 entries; the longest words go first, so that those that still run
are a slice. The last few lanes, which only very long words keep open, are ended by zlib from the state they have. A run of
words goes on from the state of its first words with a space and the next word.

One pass counts buckets (a row for each task and bucket, summed by Spark), the gain of a bucket is computed for buckets
alone, and a second pass sums the gains of each document. The noise that makes a draw without replacement from scores
depends on the seed and the id alone; ranks come from sorted ranges.

Defined results: null and empty text have no features and weight 0; a null id is hashed as the empty string and comes first
of equal scores; repeated ids keep all their rows; documents of fewer than least_words words are never drawn; target rows of
null text count nothing, their other columns are not read; empty tables give no rows, an empty target flat gains.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import stored
from tracewell.operators.ranking import numbered

BUCKETS = 10_000
GRAMS = 1
PERCENT = 10
LEAST_WORDS = 20
SEED = "2024"
BLOCK_BYTES = 1 << 22  # of text whose words are found together
LEAST_LANES = 12
START = np.uint32(0xFFFFFFFF)
SCORED = "doc_id long, n_words long, n_features long, weight long"


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether a byte belongs to a word; its lower case; the CRC of each byte."""
    b = np.arange(256)
    upper = (b >= 65) & (b <= 90)
    word = ((b >= 48) & (b <= 57)) | upper | ((b >= 97) & (b <= 122)) | (b >= 128)
    crc = b.astype(np.uint32)
    for _ in range(8):
        crc = (crc >> np.uint32(1)) ^ np.where(crc & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return word, np.where(upper, b + 32, b).astype(np.uint8), crc


def word_bounds(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of words; rows: where rows begin, and the end of the last."""
    inside = tables()[0][data]
    held = rows[:-1][rows[:-1] < rows[1:]]  # begins of rows that hold something
    change = np.zeros(len(data) + 1, bool)
    change[1:-1] = inside[1:] != inside[:-1]
    change[held] = True
    change[-1] = True
    at = np.flatnonzero(change)
    words = inside[at[:-1]]
    return at[:-1][words], at[1:][words]


def advance(state: np.ndarray, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC states (before the final inversion) after the lower-cased bytes from begins to ends, a lane each."""
    _, lower, crc = tables()
    lengths = ends - begins
    order = np.argsort(-lengths, kind="stable")
    at, sizes, lanes = begins[order], lengths[order], state[order]
    step, low = 0, np.uint32(255)
    running = np.searchsorted(-sizes, -1, "right") if len(sizes) else 0  # lanes of more than step bytes
    while running >= LEAST_LANES:
        s = lanes[:running]
        lanes[:running] = crc[(s ^ lower[data[at[:running] + step]]) & low] ^ (s >> np.uint32(8))
        step += 1
        running = int(np.searchsorted(-sizes[:running], -step, "left"))
    for k in range(running):
        rest = lower[data[at[k] + step : at[k] + sizes[k]]].tobytes()
        lanes[k] = zlib.crc32(rest, int(lanes[k] ^ START)) ^ 0xFFFFFFFF
    out = np.empty_like(lanes)
    out[order] = lanes
    return out


def features(data: np.ndarray, rows: np.ndarray, grams: int, buckets: int, known: int = 0) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Words by row; then for each number of words the rows and buckets of its runs. known: first words (of a single row) that only begin runs."""
    begins, ends = word_bounds(data, rows)
    row = np.searchsorted(rows, begins, "right") - 1
    state = advance(np.full(len(begins), START), data, begins, ends)
    found_rows, found = [], []
    for g in range(1, grams + 1):
        if g > 1:  # runs of g words from those of g - 1
            n = len(begins) - g + 1
            if n <= 0:
                break
            _, _, crc = tables()
            spaced = crc[(state[:n] ^ np.uint32(32)) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
            state = advance(spaced, data, begins[g - 1 :], ends[g - 1 :])
        one = (row[: len(state)] == row[g - 1 :]) & (np.arange(len(state)) + g - 1 >= known)
        found_rows.append(row[: len(state)][one])
        found.append(((state ^ START) % np.uint32(buckets))[one])
    return np.bincount(row[known:], minlength=len(rows) - 1), found_rows, found


def blocks(data: np.ndarray, rows: np.ndarray, grams: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Slices (first row, past row, begin, end, known words) of about BLOCK_BYTES: whole rows, or parts of one long row cut between words, each with the last grams - 1 words before it."""
    first = 0
    while first + 1 < len(rows):
        past = max(first + 1, int(np.searchsorted(rows, rows[first] + BLOCK_BYTES, "right")) - 1)
        begin, end = int(rows[first]), int(rows[past])
        if past > first + 1 or end - begin <= BLOCK_BYTES:
            yield first, past, begin, end, 0
        else:
            known, fresh = 0, begin
            while fresh < end:
                cut = fresh + BLOCK_BYTES
                while cut < end:  # to the next byte outside words
                    outside = np.flatnonzero(~tables()[0][data[cut : min(end, cut + BLOCK_BYTES)]])
                    if len(outside):
                        cut += int(outside[0])
                        break
                    cut += BLOCK_BYTES
                cut = min(cut, end)
                yield first, past, begin, cut, known
                if grams > 1:
                    begins, _ = word_bounds(data[begin:cut], np.array([0, cut - begin]))
                    known = min(grams - 1, len(begins))
                    begin += int(begins[-known]) if known else cut - begin
                else:
                    begin = cut
                fresh = cut
        first = past


def hashed(column: pa.Array, grams: int, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of parts of a column of texts: its rows from and to, words by row, and rows and buckets of features."""
    column = column.cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    if column.null_count:  # a null's slot may hold bytes
        sizes = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, np.diff(offsets))
        if (sizes != np.diff(offsets)).any():
            yield from hashed(pa.array(["" if t is None else t for t in column.to_pylist()], pa.large_string()), grams, buckets)
            return
    for first, past, begin, end, known in blocks(data, offsets, grams):
        rows = np.clip(offsets[first : past + 1], begin, end) - begin
        words, of, found = features(data[begin:end], rows, grams, buckets, known)
        empty = np.zeros(0, np.int64)
        yield first, past, words, np.concatenate([*of, empty]).astype(np.int64), np.concatenate([*found, empty]).astype(np.int64)


def bucket_counts(texts: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for *_, found in hashed(batch.column(0), grams, buckets):
                counts += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(held.astype(np.int32)), pa.array(counts[held])], ["bucket", "n"])

    rows = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # a row for each bucket
    counts = np.zeros(buckets, np.int64)
    for r in rows:
        counts[r["bucket"]] = r["n"]
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier each bucket is in the target, with one more count in each bucket."""
    buckets, all_raw, all_target = float(len(raw)), float(raw.sum()), float(target.sum())
    ratio = lambda s, t: ((t + 1.0) * (all_raw + buckets)) / ((s + 1.0) * (all_target + buckets))
    return np.array([math.floor(1000 * math.log(ratio(float(s), float(t)))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], np.int64)


def weights(documents: DataFrame, gain: np.ndarray, grams: int = GRAMS) -> DataFrame:
    """doc_id, n_words, n_features and weight of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for first, past, in_rows, rows, found in hashed(batch.column(1), grams, len(gain)):
                words[first:past] += in_rows
                n[first:past] += np.bincount(rows, minlength=past - first)
                weight[first:past] += np.bincount(rows, gain[found], past - first).astype(np.int64)  # exact below 2^53
            yield pa.record_batch([batch.column(0), pa.array(words), pa.array(n), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCORED)


def noise(doc_id: str, seed: str) -> Column:
    """Thousandths of a Gumbel variable, from a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("long")


def resample(documents: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """doc_id, n_features, weight and score of every document, and its rank in the draw (null: not drawn) of percent of those of least_words words or more."""
    gain = gains(bucket_counts(documents, grams, buckets), bucket_counts(target, grams, buckets))
    scored = weights(documents, gain, grams).withColumn("score", F.col("weight") + noise("doc_id", seed))
    scored = stored(scored.withColumn("_row", F.monotonically_increasing_id()), "resampling-scores")
    open_ = scored.where(F.col("n_words") >= least_words)
    most = percent * open_.count() // 100
    ranked = numbered(open_, "rank", F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("_row").asc())
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")).cast("long"))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def drawn(documents: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of documents that the draw takes; rows of one id share its fate, rows without an id are left out."""
    ids = resample(documents, target, **options).where(F.col("rank").isNotNull()).select("doc_id").distinct()
    return documents.join(ids, "doc_id", "left_semi")
