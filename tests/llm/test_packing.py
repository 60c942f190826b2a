"""Best-two-fit packing against the library's ids and against filling one sequence after another."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tracewell.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, length long, part int, nth long, ids string, offset int"
ODD = [None, "", " ", "a", "\n\n", "word " * 9000, "<|endoftext|>x <|endoftext|> <|startoftext|>", "don't  stop\n\tnow 'tis", "日本語 テキスト 😀", "ÅΣΑΣ ΣΑΣ́ İx y z\u0085w", "x" * 30_000, "one two", "one two"]


def one_by_one(lengths: list[int], capacity: int) -> list[list[int]]:
    """The method as it reads, without a histogram."""
    left, made = sorted(lengths, reverse=True), []
    while left:
        bin_, gap = [], capacity
        for size in left:
            if size <= gap:
                bin_.append(size)
                gap -= size
        rest = list((Counter(left) - Counter(bin_)).elements())
        if gap and len(bin_) > 1:
            room = gap + bin_[-1]
            pairs = [(a + b, a, b) for i, a in enumerate(rest) for b in rest[i + 1 :] if bin_[-1] < a + b <= room]
            if pairs:
                total = max(pairs)[0]
                a, b = max((max(a, b), min(a, b)) for s, a, b in pairs if s == total)
                bin_[-1:] = [a, b]
        made.append(sorted(bin_, reverse=True))
        left = sorted((Counter(left) - Counter(bin_)).elements(), reverse=True)
    return made


def test_plan_equals_filling_one_by_one():
    rng = random.Random(11)
    for _ in range(300):
        capacity = rng.choice([7, 20, 50])
        lengths = [rng.randint(1, capacity) if rng.random() < 0.5 else rng.choice([3, capacity // 2]) for _ in range(rng.randrange(60))]
        lines = packing.plan_sequences(Counter(lengths), capacity)
        made = [[size for size, n in line.lengths for _ in range(n)] for line in lines for _ in range(line.times)]
        assert made == one_by_one(lengths, capacity)


def test_a_pair_replaces_the_smallest():
    # greedy: 6 + 3 of 10; 2 + 2 fill the place of the 3 and the gap
    assert packing.plan_sequences({6: 1, 3: 1, 2: 2}, 10)[0].lengths == [(6, 1), (2, 2)]
    assert packing.next_sequence(np.array([4, 5, 6, 7]), np.array([2, 2, 0, 1]), 16) == {7: 1, 5: 1, 4: 1}
    assert packing.next_sequence(np.array([4, 6, 9]), np.array([2, 1, 1]), 17) == {9: 1, 4: 2}
    assert packing.best_pair(np.array([4, 5]), np.array([1, 1]), 8) is None


def test_large_counts_stay_few_lines():
    lines = packing.plan_sequences({k: 10**9 + k for k in range(1, 4097)}, 4096)
    total = sum(k * (10**9 + k) for k in range(1, 4097))
    assert len(lines) < 20_000 and lines[-1].first + lines[-1].times <= total / 4096 * 1.001
    used = Counter()
    for line in lines:
        assert sum(size * n for size, n in line.lengths) <= 4096
        for size, n in line.lengths:
            used[size] += n * line.times
    assert used == {k: 10**9 + k for k in range(1, 4097)}


def test_ids_equal_the_library():
    tokenizer, ids, rng = Tokenizer.from_file(PATH), packing.WordIds(PATH), random.Random(3)
    assert ids.by_word and not packing.drops_white_space(public_tokenizers.path("byte_bpe_50k.json"))
    parts = ["the", "ing", " ", "  ", "\n", "\t", "\x1c", " ", " ", "'s", "é", "é", "́", "1", "23", ".", "ß", "<|endoftext|>", "<|end", "😀", "zq", "Σ", "İ", "ﬁ", "각", "ㅏ"]
    for text in [*(t or "" for t in ODD), *("".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(500))]:
        assert np.frombuffer(ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_each_letter_below_u0300_equals_the_library():
    tokenizer, ids = Tokenizer.from_file(PATH), packing.WordIds(PATH)
    for text in (f"{a}{chr(c)}{b}" for c in range(0x300) for a, b in (("", ""), ("x", "'s"), ("A ", "7"))):
        assert np.frombuffer(ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)


def test_blocks_of_long_texts(monkeypatch):
    ids = packing.WordIds(PATH)
    want = [ids(t or "") for t in ODD]
    monkeypatch.setattr(packing, "BLOCK_CHARS", 5)
    assert [ids(t or "") for t in ODD] == want


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocabulary = ["ice", "river", "Moon", "7", "stone,", "deeply", "über"]
    return [*enumerate(ODD), (3, "a"), (None, "no id"), (None, None), *((100 + i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 200, 900])))) for i in range(200))]


@pytest.mark.parametrize("capacity", [4096, 1, 50])
def test_pack(spark, texts, capacity):
    docs = spark.createDataFrame([(d, t, 7, 1, 2, "x", 5) for d, t in texts if capacity > 1 or not t or len(t) < 100], DOCS)
    tokenizer = Tokenizer.from_file(PATH)
    want, lengths = Counter(), []
    for d, t in [(r["doc_id"], r["text"]) for r in docs.collect()]:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            want[d, piece, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
            lengths.append(len(own))
    packed = packing.pack(docs, PATH, capacity, ids=True)
    rows = packed.collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))] and sum(n for _, n in places) <= capacity
    assert sorted(sorted((n for _, n in p), reverse=True) for p in held.values()) == sorted(one_by_one(lengths, capacity))
    whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    assert {s: len(r["ids"]) for s, r in whole.items()} == {s: sum(n for _, n in p) for s, p in held.items()}
    for r in rows:
        own = whole[r["sequence_id"]]["ids"][r["offset"] : r["offset"] + r["length"]]
        assert zlib.crc32(np.array(own, "<u4").tobytes()) == r["ids_crc32"]
    assert set(packing.pack(docs, PATH, capacity).columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}


def test_pack_of_nothing(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), PATH).count() == 0
