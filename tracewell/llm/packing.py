"""Packing documents into sequences of a fixed number of tokens by best two fit.

A sequence is filled greedily, the longest unpacked piece that fits first. If a gap is left, its smallest piece is given
back for the two unpacked pieces whose sum is largest among those that fit the gap and the place of the smallest, if they
fill more of it. Only lengths matter for this, and there are as many lengths as a sequence has tokens. So the plan is made
on the histogram of all lengths: the sequence that comes next comes again until one of its lengths runs out, and such equal
sequences are one line of the plan, with the result of filling them one after the other. The histogram is all that comes to
the driver: a row for each length.

Tasks encode whole texts, cut what is longer than a sequence, number the pieces of each length among themselves, and write
them. A piece's number among all of its length is that plus the counts of earlier tasks, and the plan has the ranges of
numbers of each length that go to a sequence and place: a search in sorted numbers. So no piece is moved to be placed.

Defined results: null and empty text have the end id alone; null and repeated doc_ids keep all their rows, a piece each;
other columns are not read; an empty table gives no rows. Which of several pieces of one length comes where follows the
order of files and rows.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tracewell.llm.bpe_count import Memo, byte_symbols
from tracewell.llm.common import stored

CAPACITY = 4096
MOST_CAPACITY = 1 << 17  # bounds the histogram and the plan
END_ID = 1
KEPT_WORDS = 1_000_000
BLOCK_CHARS = 1 << 20  # of a text whose words are listed at once
FLUSH_IDS = 1 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>, part int, nth long"


class Lines(NamedTuple):
    """A line for each run of equal sequences: their first number, how many they are, and the lengths with their repeats."""

    first: int
    times: int
    lengths: list[tuple[int, int]]


def best_pair(lengths: np.ndarray, counts: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two lengths with the largest sum up to room, of ascending lengths that are there counts times; of equal sums that with the longest."""
    longer = lengths[(lengths < room) & (counts > 0)]
    have = counts[(lengths < room) & (counts > 0)]
    if not len(longer):
        return None
    other = np.searchsorted(longer, np.minimum(longer, room - longer), "right") - 1
    other -= (other == np.arange(len(longer))) & (have < 2)
    sums = np.where(other >= 0, longer + longer[other], 0)
    k = len(sums) - 1 - int(np.argmax(sums[::-1]))
    return (int(longer[k]), int(longer[other[k]])) if sums[k] else None


def next_sequence(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> dict[int, int]:
    """Repeats by length in the sequence that comes next; some count is positive."""
    used: dict[int, int] = {}
    left = counts.copy()
    gap = capacity
    while True:
        fits = np.flatnonzero(left[: np.searchsorted(lengths, gap, "right")])
        if not len(fits):
            break
        k = int(fits[-1])
        size = int(lengths[k])
        n = min(int(left[k]), gap // size)
        used[size] = n
        left[k] -= n
        gap -= n * size
    if gap and sum(used.values()) > 1:
        smallest = min(used)
        pair = best_pair(lengths, left, gap + smallest)
        if pair and sum(pair) > smallest:
            used[smallest] -= 1
            for size in pair:
                used[size] = used.get(size, 0) + 1
    return {size: n for size, n in sorted(used.items(), reverse=True) if n}


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Lines]:
    """Best two fit over all pieces, given how many there are of each length."""
    lengths = np.array(sorted(k for k, n in histogram.items() if n), np.int64)
    counts = np.array([histogram[k] for k in lengths.tolist()], np.int64)
    place = {k: i for i, k in enumerate(lengths.tolist())}
    lines, first = [], 0
    while counts.any():
        used = next_sequence(lengths, counts, capacity)
        times = min(int(counts[place[size]]) // n for size, n in used.items())
        for size, n in used.items():
            counts[place[size]] -= n * times
        lines.append(Lines(first, times, list(used.items())))
        first += times
        if not counts[-1]:
            keep = counts > 0
            lengths, counts = lengths[keep], counts[keep]
            place = {k: i for i, k in enumerate(lengths.tolist())}
    return lines


class Places:
    """Where the n-th piece of a length goes, from sorted ranges of numbers."""

    BITS = 44

    def __init__(self, lines: list[Lines]):
        taken: dict[int, int] = {}
        ranges = []
        for line in lines:
            at = 0
            for size, n in line.lengths:
                ranges.append((size, taken.get(size, 0), n, line.first, at))
                taken[size] = taken.get(size, 0) + n * line.times
                at += n * size
        if taken and max(taken.values()) >= 1 << self.BITS:
            raise ValueError("too many pieces of one length")
        ranges.sort()
        size, self.begin, self.repeats, self.first, self.at = np.array(ranges, np.int64).reshape(-1, 5).T.copy()
        self.keys = size << self.BITS | self.begin

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequences and offsets."""
        k = np.searchsorted(self.keys, length << self.BITS | number, "right") - 1
        turn, slot = np.divmod(number - self.begin[k], self.repeats[k])
        return self.first[k] + turn, self.at[k] + slot * length


def drops_white_space(path: str) -> bool:
    """Whether the vocabulary's own pattern never lets a piece hold white space, so that words can be encoded one by one."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    plain = not any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec.get("added_tokens", []))
    known = {"NFC", "Replace", "Lowercase"} >= {x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [{"type": ""}])}
    return plain and known and first.get("behavior") == "Removed" and first.get("invert") is True and pattern.endswith(r"[^\s\p{L}\p{N}]+") and r"\s" not in pattern[: -len(r"[^\s\p{L}\p{N}]+")]


class WordIds:
    """The library's ids of a text as little-endian 32-bit integers.

    Where white space separates, words of a bounded table aren't encoded again, and a new word of letters below U+0300
    (which normal forms leave alone) is split by the vocabulary's own pattern into pieces, of which new ones go through
    the library's model. All other words and vocabularies go through the whole library.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.by_word = drops_white_space(path)
        self.known, self.pieces = Memo(self.of_word, KEPT_WORDS), Memo(self.of_piece, KEPT_WORDS)
        self.white = re.compile(r"[\x20\x09-\x0D]").search
        self.separators = re.compile(r"[\x1C-\x1F]").search  # white for Python, not for the library
        self.words = re.compile(r"[^\x20\x09-\x0D]+").findall
        self.plain = re.compile(r"[\x00-\u02FF]*").fullmatch
        self.stand_ins = {b: c for c, b in byte_symbols().items()}
        if self.by_word:
            with open(path, encoding="utf-8") as f:
                self.split = regex.compile(json.load(f)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall

    @staticmethod
    def raw(ids: list[int]) -> bytes:
        values = array("I", ids)
        if sys.byteorder == "big":
            values.byteswap()
        return values.tobytes()

    def encoded(self, text: str) -> bytes:
        return self.raw(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def of_piece(self, piece: str) -> bytes:
        symbols = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.stand_ins)
        return self.raw([t.id for t in self.model.tokenize(symbols)])

    def of_word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():  # one piece
            return self.pieces[word.lower()]
        if "<|" in word or not self.plain(word):
            return self.encoded(word)
        return b"".join(map(self.pieces.__getitem__, self.split(word.lower())))

    def __call__(self, text: str) -> bytes:
        if not self.by_word:
            return self.encoded(text)
        if len(text) <= BLOCK_CHARS and not self.separators(text):
            return b"".join(map(self.known.__getitem__, text.split()))
        parts, begin = [], 0
        while begin < len(text):
            white = self.white(text, begin + BLOCK_CHARS)
            end = white.start() if white else len(text)
            parts.append(b"".join(map(self.known.__getitem__, self.words(text, begin, end))))
            begin = end
        return b"".join(parts)


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One for all tasks of a worker."""
    return WordIds(path)


def cut_pieces(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Encodes every text, appends the end id, cuts what is longer than capacity, and writes the pieces with their ids, the task and their number among the task's pieces of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = word_ids(vocabulary), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        seen: dict[int, int] = {}
        rows: list[tuple] = []
        parts: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            ids = pa.array(np.frombuffer(b"".join(parts), "<u4").astype(np.int32))
            bounds = pa.array([0, *accumulate(columns[3])], pa.int32())
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
            arrays += [pa.ListArray.from_arrays(bounds, ids), pa.array([part] * len(rows), pa.int32()), pa.array(columns[5], pa.int64())]
            return pa.record_batch(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "part", "nth"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):  # not whole columns: texts may be long
                doc_id, ids = doc_id.as_py(), encode(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    length = len(own) // 4
                    rows.append((doc_id, piece, at // 4, length, zlib.crc32(own), seen.get(length, 0)))
                    seen[length] = seen.get(length, 0) + 1
                    parts.append(own)
                    held += length
                    if held >= FLUSH_IDS:
                        yield flush()
                        rows.clear(), parts.clear()
                        held = 0
        if rows:
            yield flush()

    return stored(documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES), "pieces")


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to written pieces."""
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n"))  # a row for each task
    counts = stored(counts, "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row for each length
    places = Places(plan_sequences(histogram, capacity))
    rest = [c for c in pieces.columns if c not in ("part", "nth")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places(batch.column("length").to_numpy(), batch.column("number").to_numpy())
            kept = batch.select(rest)
            yield pa.record_batch([*kept.columns, pa.array(sequence), pa.array(offset)], [*rest, "sequence_id", "offset"])

    numbered = pieces.join(counts.select("length", "part", "before"), ["length", "part"]).select(*rest, (F.col("before") + F.col("nth")).alias("number"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name in rest)
    return numbered.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """One row for each piece of each document: what it is (doc_id, piece, start, length, ids_crc32, with ids=True its ids) and where it is (sequence_id, offset)."""
    if not 1 <= capacity <= MOST_CAPACITY:
        raise ValueError(f"capacity must be from 1 to {MOST_CAPACITY}")
    pieces = cut_pieces(documents, vocabulary, capacity, end_id)
    return place_pieces(pieces if ids else pieces.drop("ids"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from pack(..., ids=True): their ids, and the documents in them with where each begins."""
    held = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))  # as many tokens as a sequence has
    rows = packed.groupBy("sequence_id").agg(held.alias("held"))
    documents = F.transform("held", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["offset"].alias("offset"), p["length"].alias("length")))
    return rows.select("sequence_id", F.flatten("held.ids").alias("ids"), documents.alias("documents"))
