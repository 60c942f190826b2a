"""Importance resampling against plain Python and against its SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tracewell.llm import resampling
from tracewell.llm.queries import SQL

DOCS = "doc_id long, text string, weight int, score double, n_words string, rank int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = [None, "", " ", "A", "b\x00C", "Zażółć GĘŚLĄ jaźń", "日本語 テキスト😀", "x" * 100_000, ("longword" * 30 + " ") * 40, "don't-stop_now 7up", "é" * 70, "\x7f\x80  a"]


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def plain_features(text, grams):
    words = WORD.findall(lower(text))
    return [" ".join(words[i : i + g]) for g in range(1, grams + 1) for i in range(len(words) - g + 1)]


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def plain(rows, target, grams, buckets, percent, least):
    raw = Counter(bucket(f, buckets) for _, t in rows for f in plain_features(t, grams))
    aim = Counter(bucket(f, buckets) for t in target for f in plain_features(t, grams))
    s, t = sum(raw.values()), sum(aim.values())
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets))))
    out = []
    for d, text in rows:
        found = plain_features(text, grams)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f, buckets)) for f in found)
        out.append([d, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(WORD.findall(lower(text)))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in out)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(13)
    words = ["river", "Stone", "glass", "7", "über", "日本", "tree-top", "x", "averyveryverylongword"]
    rows = [*enumerate(ODD), *((100 + i, " ".join(rng.choices(words, k=rng.randrange(60)))) for i in range(300)), (100, "the same id"), (None, "river " * 30), (None, "river " * 30)]
    target = ["river stone glass " * 5, "averyveryverylongword über", None, ""]
    return rows, target, spark.createDataFrame([(d, t, 1, 0.5, "n", 3) for d, t in rows], DOCS), spark.createDataFrame([(None, t) for t in target], "item_id long, text string")


@pytest.mark.parametrize("grams,buckets,percent,least", [(1, 10_000, 10, 20), (3, 97, 50, 1), (2, 10_000, 100, 0)])
def test_resample(tables, grams, buckets, percent, least):
    rows, target, docs, aim = tables
    got = resampling.resample(docs, aim, grams, buckets, percent, least)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert Counter(tuple(r) for r in got.collect()) == plain(rows, target, grams, buckets, percent, least)


def test_sql(tables):
    _, _, docs, aim = tables
    duck = duckdb.connect()
    documents, benchmark = docs.select("doc_id", "text").where("doc_id is not null and doc_id <> 100").toPandas(), aim.toPandas()
    duck.register("documents", documents), duck.register("benchmark", benchmark)
    got = resampling.resample(docs.where("doc_id is not null and doc_id <> 100"), aim)
    want = duck.execute(SQL["op13_importance_resampling"]).fetchall()
    names = [d[0] for d in duck.description]
    assert sorted(names) == sorted(got.columns)
    assert Counter(tuple(r) for r in got.select(*names).collect()) == Counter(want)


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 22])
@pytest.mark.parametrize("lanes", [1, 12, 10**9])
def test_blocks_and_lanes_change_nothing(monkeypatch, block, lanes):
    monkeypatch.setattr(resampling, "BLOCK_BYTES", block)
    monkeypatch.setattr(resampling, "LEAST_LANES", lanes)
    texts = [*ODD[:7], "a b c d e f g h i j k", "x" * 50, *ODD[9:]]
    for column in (pa.array(texts), pa.array(["skipped", *texts, "z"]).slice(1, len(texts)), pa.array(texts[::-1][:5])):
        for grams in (1, 2, 4):
            got, words = Counter(), np.zeros(len(column), int)
            for first, past, in_rows, rows, found in resampling.hashed(column, grams, 1000):
                got.update(zip((rows + first).tolist(), found.tolist()))
                words[first:past] += in_rows
            assert got == Counter((i, bucket(f, 1000)) for i, t in enumerate(column.to_pylist()) for f in plain_features(t, grams))
            assert words.tolist() == [len(WORD.findall(lower(t))) for t in column.to_pylist()]


def test_drawn_rows(tables):
    _, _, docs, aim = tables
    ids = {r["doc_id"] for r in resampling.resample(docs, aim).where("rank is not null").collect()} - {None}
    rows = resampling.drawn(docs, aim)
    assert rows.columns == docs.columns and {r["doc_id"] for r in rows.collect()} == ids


def test_empty_tables(spark, tables):
    _, _, docs, aim = tables
    assert resampling.resample(docs.limit(0), aim).count() == 0
    rows = resampling.resample(docs, aim.limit(0)).collect()
    assert len(rows) == docs.count() and any(r["rank"] for r in rows)
