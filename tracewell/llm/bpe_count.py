"""Token counts by heap-and-linked-list byte-pair merging, without token ids.

A text falls into pieces by the vocabulary's splitting pattern. A piece starts as its bytes, held in a doubly linked
list; a heap gives the adjacent pair of lowest rank (the leftmost of equal ones), which is merged until no pair has a
rank. The count is the number of bytes less the number of merges. Counts of pieces and of words are kept in tables of
bounded size, as natural text repeats both.

Defined results: null and empty text have 0 bytes and 0 tokens; special strings of the vocabulary that occur in a text
count one each, as the library has it by default; repeated rows are counted each; other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import pre_tokenizers

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
#: Fixed value: how byte-level vocabularies split text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEPT_PIECES = 1_000_000
KEPT_WORDS = 500_000
LONGEST_KEPT = 64
#: Code points that the two pattern libraries class differently (letters of late Unicode versions), and planes not compared.
UNSURE = "[\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c\uab6d\U00010000-\U0001efff\U0001fb00-\U0001ffff\U0002a6e0-\U0010ffff]"


class Splitter:
    """The pieces of a text; where code points are unsure, the tokenizers library splits."""

    def __init__(self):
        self.plain, self.unsure = regex.compile(PATTERN).findall, re.compile(UNSURE).search
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or not self.unsure(text):
            return self.plain(text)
        return [text[a:b] for _, (a, b) in self.library(text)]


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabulary files have for bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


SHIFT = 20


@lru_cache(maxsize=2)
def merge_ranks(path: str) -> tuple[dict[int, int], list[str]]:
    """Ranks of pairs, and the special strings.

    Inside a piece a byte is the symbol of its value and what merge r makes is the symbol 256 + r; the key of a pair is
    left << SHIFT | right. Symbols only serve to look up pairs; they aren't the vocabulary's ids.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    of = dict(byte_symbols())
    ranks: dict[int, int] = {}
    for rank, m in enumerate(spec["model"]["merges"]):
        left, right = m.split(" ") if isinstance(m, str) else m
        ranks[of[left] << SHIFT | of[right]] = rank
        of.setdefault(left + right, 256 + rank)
    return ranks, [x["content"] for x in spec.get("added_tokens", [])]


def count_piece(piece: bytes, ranks: dict[int, int]) -> int:
    """Symbols that are left of a piece after all merges. A heap entry is rank << bits | position of the left symbol, with bits enough for any position."""
    n = len(piece)
    if n < 2:
        return n
    bits = n.bit_length()
    symbol, rank_of, low = list(piece), ranks.get, (1 << bits) - 1
    heap = [r << bits | i for i in range(n - 1) if (r := rank_of(symbol[i] << SHIFT | symbol[i + 1])) is not None]
    if not heap:
        return n
    heapq.heapify(heap)
    after, before, left_over = list(range(1, n + 1)), list(range(-1, n - 1)), n
    while heap:
        top = heapq.heappop(heap)
        i, rank = top & low, top >> bits
        j = after[i]
        if j >= n or symbol[i] < 0 or rank_of(symbol[i] << SHIFT | symbol[j]) != rank:
            continue  # one of the two has been merged since
        symbol[i] = made = 256 + rank
        symbol[j] = -1
        left_over -= 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := rank_of(made << SHIFT | symbol[k])) is not None:
                heapq.heappush(heap, r << bits | i)
        if (h := before[i]) >= 0 and (r := rank_of(symbol[h] << SHIFT | made)) is not None:
            heapq.heappush(heap, r << bits | h)
    return left_over


class Memo(dict):
    """Values by string, computed on demand. Emptied when full, and without long strings, so that its bytes are bounded."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key: str):
        value = self.compute(key)
        if len(key) <= LONGEST_KEPT:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class Words:
    """The units of a text that are tokenized on their own: what starts at a space between two characters that are not white.

    A piece holds a space only as its first character or in a run of white space, so where no run has a space after its
    first character, the text can be cut before every space. Units repeat more than texts, and are found faster than pieces.
    """

    def __init__(self, whole, most: int):
        self.whole = whole
        self.spaced = Memo(lambda word: whole(" " + word), most)
        self.run = re.compile(r"\s |\s\Z").search

    def __call__(self, text: str) -> list:
        if not text:
            return []
        if text[0] == " " or self.run(text):
            return [self.whole(text)]
        first, *rest = text.split(" ")
        return [self.whole(first), *map(self.spaced.__getitem__, rest)]


class Counter:
    def __init__(self, path: str):
        ranks, special = merge_ranks(path)
        self.counts = Memo(lambda piece: count_piece(piece.encode("utf-8", "surrogatepass"), ranks), KEPT_PIECES)
        self.pieces, self.units = Splitter(), Words(self.of_pieces, KEPT_WORDS)
        self.special = special
        self.parts = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def of_pieces(self, text: str) -> int:
        parts = self.parts.split(text) if any(x in text for x in self.special) else [text]
        return len(parts) - 1 + sum(sum(map(self.counts.__getitem__, self.pieces(part))) for part in parts)

    def __call__(self, text: str) -> int:
        return sum(self.units(text))


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    """One for all tasks of a worker."""
    return Counter(path)


def count_tokens(documents: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """Bytes and tokens of every text; vocabulary: a byte-level BPE file in JSON, there on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = list(map(count, texts))
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens])], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)
