"""Toxicity by logistic regression on hashed word n-grams and skip-grams, fitted by FTRL-proximal.

Features of a text are the distinct hash buckets of its words, word pairs and pairs that skip one word (ASCII lower
case, punctuation at the ends removed). The fit holds z and n for each bucket: the step of a bucket shrinks with the
squares of its own gradients, and L1 keeps a weight at exactly 0 until |z| exceeds it, so that few weights remain; those
(at most 2^BITS) are broadcast. L1 is the strength that loses least on a quarter of the sample that the fit for this choice
leaves out. On that quarter the sums of weights are also put through a logistic curve, both labels weighing the same, as few
texts are toxic; the model is then fitted on the whole sample and its sums take the same slope and offset: at most SAMPLE documents of each label and FIT_FEATURES distinct
buckets of documents in all, whole documents in either case.

Defined results: null and empty texts have no feature and score sigmoid(bias); repeated rows are scored each; without
labelled rows of both kinds all weights are 0 and every score is the share of label 1 with one example added to each side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.bpe_count import Memo
from tracewell.llm.common import bounded, held_out, labelled_sample, logistic, mix64, stored

BITS = 20
SAMPLE = {0: 9000, 1: 4000}
FIT_FEATURES = 30_000_000
L1 = (1.0, 3.0, 10.0)
KEPT_WORDS = 500_000
MARKS = b".,;:!?\"'()[]{}#*$%&|<>-"


@lru_cache(maxsize=1)
def word_hashes() -> Memo:
    """Hashes by word, for all tasks of a worker."""
    return Memo(lambda w: xxhash.xxh3_64_intdigest(w.strip(MARKS)), KEPT_WORDS)


def buckets(text: str | None) -> np.ndarray:
    """The bucket of every word, pair and skipping pair, with repeats."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    h = np.fromiter(map(word_hashes().__getitem__, found), np.uint64, len(found))
    pair = lambda gap, salt: mix64(h[:-gap] * np.uint64(salt) + h[gap:]) if len(h) > gap else h[:0]
    grams = np.concatenate([h, pair(1, 0x9E3779B97F4A7C15), pair(2, 0xC2B2AE3D27D4EB4F)])
    return (grams >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass
class Model:
    bias: float
    index: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BITS, np.float32)
        w[self.index] = self.weight
        return w


def ftrl(examples: list[tuple[np.ndarray, int]], alpha: float = 1.0, beta: float = 1.0, l1: float = 10.0, l2: float = 0.1, epochs: int = 4) -> Model:
    """examples: distinct buckets, and 0 or 1. The bias is a coordinate without L1."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    last = 1 << BITS
    order = np.random.default_rng(5)
    positive = sum(y for _, y in examples)
    if not 0 < positive < len(examples):
        return Model(float(np.log((positive + 1) / (len(examples) - positive + 1))), np.zeros(0, np.int64), np.zeros(0, np.float32))

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        w[(np.abs(zi) <= l1) & (i != last)] = 0
        own = i == last
        w[own] = -zi[own] / ((beta + np.sqrt(n[i][own])) / alpha)
        return w

    with_bias = [(np.append(i, last), y) for i, y in examples]
    for _ in range(epochs):
        for k in order.permutation(len(with_bias)):
            i, y = with_bias[k]
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            grown = n[i] + g * g
            z[i] += g - (np.sqrt(grown) - np.sqrt(n[i])) / alpha * w
            n[i] = grown
    w = weights(np.arange(last + 1))
    index = np.flatnonzero(w[:-1])
    return Model(float(w[-1]), index, w[index].astype(np.float32))


def sums(model: Model, examples: list[tuple[np.ndarray, int]]) -> np.ndarray:
    dense = model.dense()
    return np.array([model.bias + float(dense[i].sum()) for i, _ in examples])


def loss(model: Model, examples: list[tuple[np.ndarray, int]]) -> float:
    """Mean log loss, both labels weighing the same."""
    by_label = ([], [])
    for score, (_, y) in zip(np.clip(sums(model, examples), -35, 35), examples, strict=True):
        by_label[y].append(np.log1p(np.exp(-score if y else score)))
    return float(np.mean([np.mean(x) for x in by_label if x]))


def calibrated(model: Model, slope: float, offset: float) -> Model:
    return Model(slope * model.bias + offset, model.index, (slope * model.weight).astype(np.float32))


def fit(examples: list[tuple[np.ndarray, int]]) -> Model:
    """ftrl() with the strength of L1 that loses least on every fourth example of each label, calibrated on these."""
    turn, check = [0, 0], []
    for _, y in examples:
        check.append(turn[y] % 4 == 3)
        turn[y] += 1
    left_out = [e for e, c in zip(examples, check, strict=True) if c]
    others = [e for e, c in zip(examples, check, strict=True) if not c]
    if len({y for _, y in left_out}) < 2:
        return ftrl(examples, l1=L1[0])
    tried = {l1: ftrl(others, l1=l1) for l1 in L1}
    best = min(L1, key=lambda l1: loss(tried[l1], left_out))
    slope, offset = logistic(sums(tried[best], left_out), np.array([y for _, y in left_out]))
    model = ftrl(examples, l1=best)
    return calibrated(model, slope, offset) if slope > 0 else model


def fit_toxicity(documents: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE) -> Model:
    """A model from a sample of labelled documents of bounded size; only hashed features come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(buckets(t)) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "label", "buckets"])

    rows = labelled_sample(documents, labels, "toxic", sample).mapInArrow(run, "doc_id long, label int, buckets array<int>")
    rows = stored(rows.withColumn("n", F.size("buckets")), "toxic-sample")
    got = bounded(rows, "n", FIT_FEATURES).toArrow()
    order = np.argsort(got.column("doc_id").to_numpy(), kind="stable")
    flat = got.column("buckets").combine_chunks()
    offsets, values, y = flat.offsets.to_numpy(), flat.values.to_numpy(), got.column("label").to_numpy()
    return fit([(values[offsets[k] : offsets[k + 1]], int(y[k])) for k in order])


def score_toxicity(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every text."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, bias = sent.value.dense(), sent.value.bias
        for batch in batches:
            scores = []
            for text in batch.column(2).to_pylist():
                found = buckets(text)
                hit = np.unique(found[dense[found] != 0])  # few
                scores.append(1 / (1 + np.exp(-np.clip(bias + float(dense[hit].sum()), -500, 500))))
            p = np.array(scores, float)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = documents.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")
