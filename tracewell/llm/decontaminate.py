"""Benchmark passages in documents, found approximately by q-gram filtering on diagonals and verified by alignment.

Texts are lower-cased and runs of white space become one space. A benchmark text falls into overlapping segments of
SEGMENT characters (shorter texts are one segment). A segment of m characters occurs in a document with at most e edits
only where, by the q-gram lemma, the two share m - q + 1 - q * e character q-grams, all on diagonals (document position
less segment position) no further than e apart. So shared q-grams are counted by segment and diagonal band, bands of
2 * (e + 1) diagonals overlapping by half; bands below the bound are dropped, and what is left is verified by a banded
alignment. A document is contaminated by the benchmark texts that have a verified segment in it. Equal segments are one,
so that repeating texts don't multiply the q-grams that a document shares with them, and shared q-grams are counted in
parts of bounded size.

The benchmark is a set of queries against all documents. Its segments are dealt by hash to blocks of at most about
BLOCK_CHARS characters, which are indexed and broadcast; a larger benchmark, or a longer text of it, takes more blocks,
through which the documents go one after the other.

Defined results: null, empty and very short documents hold nothing; benchmark texts with fewer than q + 1 characters
(null and empty ones too) cannot be told from chance and match nothing; repeated rows are searched each; several benchmark
rows with one id count as one, and so do those without an id, which stand as null, first, among the ids found; extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import mix64, stored

Q = 8
SEGMENT = 80
STEP = 40
EDIT_SHARE = 0.075
BLOCK_CHARS = 8_000_000  # of segments, which overlap by half
TABLE_BITS = 22
MOST_PAIRS = 1_000_000  # of q-grams counted at once


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """The hash of the Q characters from every position, by doubling."""
    h, width = mix64(codes.astype(np.uint64) + np.uint64(1)), 1
    while width < Q:
        h = h[: max(0, len(h) - width)] * np.uint64(0x9E3779B97F4A7C15 + 2 * width) + h[width:]
        width *= 2
    return h


@dataclass(frozen=True)
class Segment:
    item_ids: tuple[int, ...]
    text: str
    edits: int
    least: int  # shared q-grams


def pieces_of(text: str | None) -> list[str]:
    """The overlapping segments of a benchmark text that can be searched."""
    text = normal(text)
    last = max(0, len(text) - SEGMENT)
    pieces = (text[start : start + SEGMENT] for start in dict.fromkeys([*range(0, last, STEP), last]))
    return [p for p in pieces if len(p) > Q]


def segment_of(item_ids: tuple[int, ...], piece: str) -> Segment:
    edits = int(len(piece) * EDIT_SHARE)
    while edits and len(piece) - Q + 1 - Q * edits < Q:
        edits -= 1
    return Segment(item_ids, piece, edits, len(piece) - Q + 1 - Q * edits)


def segments_of(item_id: int, text: str | None) -> list[Segment]:
    return [segment_of((item_id,), p) for p in pieces_of(text)]


def edits_within(segment: np.ndarray, text: np.ndarray, diagonal: int, width: int, most: int) -> bool:
    """Whether segment aligns with some part of text in at most `most` edits, on diagonals from diagonal to diagonal + width - 1."""
    # row i holds, for each diagonal d, the cost of segment[:i] against text that ends before i + d
    d = np.arange(diagonal, diagonal + width)
    far = most + 1
    cost = np.where((d >= 0) & (d <= len(text)), 0, far)  # a part may start anywhere
    ramp = np.arange(width)
    for i in range(1, len(segment) + 1):
        end = d + i
        inside = (end >= 1) & (end <= len(text))
        same = np.zeros(width, bool)
        same[inside] = text[end[inside] - 1] == segment[i - 1]
        new = np.where(inside, cost + ~same, far)
        new[:-1] = np.minimum(new[:-1], cost[1:] + 1)  # a character of the segment that text lacks
        new = np.where((end >= 0) & (end <= len(text)), new, far)
        new = np.minimum.accumulate(new - ramp) + ramp  # characters that only text has
        cost = np.minimum(new, far)
        if cost.min() > most:
            return False
    return True


class Index:
    """The q-grams of segments; find() searches one document."""

    def __init__(self, segments: list[Segment]):
        items: dict[str, dict[int, None]] = {}
        for s in segments:
            items.setdefault(s.text, {}).update(dict.fromkeys(s.item_ids))
        first = {s.text: s for s in reversed(segments)}
        self.segments = segments = [replace(first[text], item_ids=tuple(sorted(ids))) for text, ids in items.items()]
        self.codes = [codes_of(s.text) for s in segments]
        grams = [gram_hashes(c) for c in self.codes]
        sizes = [len(g) for g in grams]
        values = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        owner, at = np.repeat(np.arange(len(grams)), sizes), np.concatenate([np.arange(n) for n in sizes]) if sizes else np.zeros(0, int)
        order = np.argsort(values, kind="stable")
        self.values, self.owner, self.at = values[order], owner[order], at[order]
        self.may = np.zeros(1 << TABLE_BITS, bool)
        self.may[self.values >> np.uint64(64 - TABLE_BITS)] = True
        self.least = np.array([s.least for s in segments], np.int64)
        self.edits = np.array([s.edits for s in segments], np.int64)
        self.window = max((len(s.text) + s.edits for s in segments), default=1)
        self.fewest = int(self.least.min()) if segments else 0

    def find(self, text: str | None) -> list[int]:
        """The ids of benchmark texts of which a segment occurs."""
        clean = normal(text)
        if len(clean) < Q or not self.segments:
            return []
        codes = codes_of(clean)
        grams = gram_hashes(codes)
        maybe = np.concatenate([[0], np.cumsum(self.may[grams >> np.uint64(64 - TABLE_BITS)])])
        # q-grams that a window as long as the longest match has at most in common with any segment
        in_window = maybe[np.minimum(np.arange(len(grams)) + self.window, len(grams))] - maybe[:-1]
        starts = np.flatnonzero(in_window >= self.fewest)
        if not len(starts):
            return []
        near = np.zeros(len(grams) + 1, np.int64)
        np.add.at(near, starts, 1)
        np.add.at(near, np.minimum(starts + self.window, len(grams)), -1)
        place = np.flatnonzero(np.cumsum(near[:-1]) > 0)
        first, past = np.searchsorted(self.values, grams[place], "left"), np.searchsorted(self.values, grams[place], "right")
        some = past > first
        place, first, times = place[some], first[some], (past - first)[some]
        if not len(place):
            return []
        counted = []
        cuts = np.flatnonzero(np.diff(np.cumsum(times) // MOST_PAIRS)) + 1
        for at, lo, n in zip(*(np.split(x, cuts) for x in (place, first, times)), strict=True):
            rows = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            who, diagonal = self.owner[rows], np.repeat(at, n) - self.at[rows]
            band = (diagonal + self.window) // (self.edits[who] + 1)  # this band and the one before cover the diagonal
            counted.append(np.unique(np.concatenate([who << 40 | band, who << 40 | (band - 1)]), return_counts=True))
        keys, where = np.unique(np.concatenate([k for k, _ in counted]), return_inverse=True)
        shared = np.bincount(where, np.concatenate([c for _, c in counted])).astype(np.int64)
        who, band = keys >> 40, keys & (1 << 40) - 1
        found: set[int] = set()
        for k in np.flatnonzero(shared >= self.least[who]).tolist():
            segment, s = self.segments[who[k]], int(who[k])
            if found.issuperset(segment.item_ids):
                continue
            start = int(band[k]) * (segment.edits + 1) - self.window
            # the alignment may leave the diagonals of shared q-grams by its edits
            if edits_within(self.codes[s], codes, start - segment.edits, 4 * segment.edits + 3, segment.edits):
                found.update(segment.item_ids)
        return sorted(found)


NO_ID = -(1 << 63)  # stands for null while texts are searched


def index_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[Index]:
    """Indexes of bounded parts of the benchmark's segments; a segment lies in one part, with the ids of all items that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item_id, text in zip(batch.column(0), batch.column(1), strict=True):
                pieces = pieces_of(text.as_py())
                yield pa.record_batch([pa.array([item_id.as_py()] * len(pieces), pa.int64()), pa.array(pieces, pa.string())], ["item_id", "piece"])

    items = benchmark.where("text is not null").select(F.coalesce(F.col("item_id").cast("long"), F.lit(NO_ID)).alias("item_id"), "text")
    segments = items.mapInArrow(run, "item_id long, piece string").groupBy("piece").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    segments = stored(segments, "benchmark-segments")
    size = segments.agg(F.sum(F.length("piece"))).first()[0] or 0
    parts = max(1, -(-size // block_chars))
    for k in range(parts):
        rows = segments.where(F.pmod(F.xxhash64("piece"), F.lit(parts)) == k).orderBy("piece").collect()  # about block_chars characters
        yield Index([segment_of(tuple(r["item_ids"]), r["piece"]) for r in rows])


def contaminated(documents: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id and item_ids (in order) of the rows of documents that hold passages of the benchmark, one row for each."""
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.array().cast("array<long>").alias("item_ids"))
    for index in index_blocks(benchmark, block_chars):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in batches:
                hits = [sorted({*known, *index.find(t)}) for t, known in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(hits, pa.list_(pa.int64()))], ["doc_id", "text", "item_ids"])

        rows = rows.mapInArrow(run, "doc_id long, text string, item_ids array<long>")
    ids = F.transform("item_ids", lambda i: F.when(i != NO_ID, i))
    return rows.where(F.size("item_ids") > 0).select("doc_id", ids.alias("item_ids"))


def without_benchmark(documents: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of documents that hold no passage of the benchmark, with all their columns. Items without an id count too."""
    spark, at = documents.sparkSession, documents.columns.index("text")
    for index in index_blocks(benchmark, block_chars):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in batches:
                yield batch.filter(pa.array([not index.find(t) for t in batch.column(at).to_pylist()], pa.bool_()))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
