"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad. Its potential is linear in features of its own and of the lines before and after it;
a 2 x 2 matrix weighs the labels of neighbouring lines. Forward-backward gives each line's marginal probability of being
good; a document's score is their mean weighted by line length, put through a logistic curve that was fitted, with the
field, on a bounded sample of labelled documents (lines inherit their document's label): at most SAMPLE documents of each
label and FIT_LINES lines in all, whole documents in either case; very long ones
come last, so that they take no other document's place. The fit reads texts of more than CHAIN lines as several chains,
without the links between them, that together weigh as much as one text; calibration and scoring have one chain at any
length.

Defined results: null and empty texts are one empty line; a line's length counts one more than its characters, so empty
lines weigh little and no document has weight 0; repeated rows are scored each; without labelled rows of both kinds all
scores are 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import bounded, drop_tables, held_out, labelled_sample, logistic, stored

SAMPLE = {0: 3000, 1: 6000}
THRESHOLD = 0.3
OWN = ("symbols", "capitals", "exclaims", "repeats", "short_words", "long_words", "digits", "seen_before", "few_words", "no_words")
#: Which of a line's features its neighbours look at.
NEAR = ("symbols", "capitals", "repeats", "seen_before")
N_FEATURES = 1 + len(OWN) + 2 * (len(NEAR) + 1)
FIT_LINES = 500_000
CHAIN = 512
BATCH_LINES = 100_000
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def own_features(line: str, seen: set[str]) -> tuple[float, ...]:
    found = line.split()
    n, size = len(found), max(1, len(line))
    count = lambda chars: sum(map(line.count, chars))
    mean = sum(map(len, found)) / n if n else 0.0
    before = bool(n) and line in seen
    if n:
        seen.add(line)
    return (
        min(1.0, 4 * count(SYMBOLS) / size), min(1.0, 2 * count(CAPITALS) / size), min(1.0, 8 * line.count("!") / size), 1 - len(set(found)) / n if n > 1 else 0.0,
        max(0.0, 4 - mean) / 4 if n else 0.0, min(1.0, max(0.0, mean - 8) / 8), min(1.0, 4 * count("0123456789") / size), float(before), float(0 < n < 5), float(n == 0),
    )


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each line, and the lines' lengths plus 1."""
    lines = (text or "").split("\n")
    seen: set[str] = set()
    own = np.array([own_features(line, seen) for line in lines])
    near = own[:, [OWN.index(f) for f in NEAR]]
    n = len(lines)
    x = np.zeros((n, N_FEATURES))
    x[:, 0], x[:, 1 : 1 + len(OWN)] = 1, own
    a, b = 1 + len(OWN), 2 + len(OWN) + len(NEAR)
    x[1:, a : b - 1], x[:-1, b : b + len(NEAR)] = near[:-1], near[1:]
    x[0, b - 1] = x[-1, -1] = 1  # no line before, none after
    return x, np.array([len(line) + 1 for line in lines], float)


@dataclass
class Field:
    weights: np.ndarray  # of the features, for good against bad
    links: np.ndarray  # links[a, b]: of label a followed by b; 0 bad, 1 good
    slope: float
    offset: float

    def marginals(self, x: np.ndarray) -> list[float]:
        """Each line's probability of being good, by scaled forward-backward."""
        good = np.exp(np.clip(x @ self.weights, -30, 30)).tolist()  # against 1 for bad
        (bb, bg), (gb, gg) = np.exp(self.links).tolist()
        n = len(good)
        forward = [0.0] * n  # share of good
        f = forward[0] = good[0] / (1 + good[0])
        for i in range(1, n):
            g = ((1 - f) * bg + f * gg) * good[i]
            f = forward[i] = g / (g + (1 - f) * bb + f * gb)
        p, back = forward, 0.5
        for i in range(n - 2, -1, -1):
            g, b = back * good[i + 1], 1 - back
            to_good, to_bad = gb * b + gg * g, bb * b + bg * g
            back = to_good / (to_good + to_bad)
            f = forward[i]
            p[i] = f * back / (f * back + (1 - f) * (1 - back))
        return p

    def mean(self, text: str | None) -> float:
        x, size = line_features(text)
        return float(np.dot(self.marginals(x), size) / size.sum())

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * self.mean(text) + self.offset))))


def chain_gradient(x: np.ndarray, y: np.ndarray, mask: np.ndarray, weights: np.ndarray, links: np.ndarray, share: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of the mean log-likelihood. x: chains, lines, features; y: labels of lines; mask: which lines there are; share: how much each chain weighs (1)."""
    chains, length, _ = x.shape
    share = np.ones(chains) if share is None else share
    good = x @ weights
    alpha = np.zeros((chains, length, 2))
    alpha[:, 0, 1] = good[:, 0]
    lse = lambda a, b: np.logaddexp(a, b)
    for t in range(1, length):
        before = alpha[:, t - 1]
        step = np.stack([lse(before[:, 0] + links[0, k], before[:, 1] + links[1, k]) for k in (0, 1)], 1)
        step[:, 1] += good[:, t]
        alpha[:, t] = np.where(mask[:, t, None], step, before)
    beta = np.zeros((chains, length, 2))
    pairs = np.zeros((2, 2))
    total = lse(alpha[:, -1, 0], alpha[:, -1, 1])
    for t in range(length - 2, -1, -1):
        ahead = beta[:, t + 1].copy()
        ahead[:, 1] += good[:, t + 1]
        there = mask[:, t + 1]
        for a in (0, 1):
            for b in (0, 1):
                p = np.exp(alpha[:, t, a] + links[a, b] + ahead[:, b] - total)
                pairs[a, b] += share[(y[:, t] == a) & (y[:, t + 1] == b) & there].sum() - (share * p)[there].sum()
        back = np.stack([lse(links[k, 0] + ahead[:, 0], links[k, 1] + ahead[:, 1]) for k in (0, 1)], 1)
        beta[:, t] = np.where(there[:, None], back, beta[:, t + 1])
    p_good = np.exp(alpha[:, :, 1] + beta[:, :, 1] - total[:, None])
    off = np.where(mask, y - p_good, 0) * share[:, None]
    return np.einsum("ct,ctf->f", off, x) / chains, pairs / chains


def fit_field(examples: list[tuple[np.ndarray, np.ndarray, int]], steps: int = 150, rate: float = 0.15, decay: float = 1e-3) -> Field:
    """examples: features and lengths of lines, label of the document. Adam on the penalised likelihood."""
    labels = {y for _, _, y in examples}
    if len(labels) < 2:
        return Field(np.zeros(N_FEATURES), np.zeros((2, 2)), 0.0, 0.0)
    parts = [(x[i : i + CHAIN], y, min(1.0, CHAIN / len(x))) for x, _, y in examples for i in range(0, len(x), CHAIN)]
    parts.sort(key=lambda p: -len(p[0]))
    batches, i = [], 0
    while i < len(parts):  # of like lengths
        longest = len(parts[i][0])
        chunk = parts[i : i + max(1, BATCH_LINES // longest)]
        i += len(chunk)
        x, y, mask = np.zeros((len(chunk), longest, N_FEATURES)), np.zeros((len(chunk), longest), int), np.zeros((len(chunk), longest), bool)
        for k, (lines, label, _) in enumerate(chunk):
            x[k, : len(lines)], y[k], mask[k, : len(lines)] = lines, label, True
        batches.append((x, y, mask, np.array([share for *_, share in chunk])))
    theta = np.zeros(N_FEATURES + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        parts_of = [chain_gradient(*b[:3], theta[:-4], theta[-4:].reshape(2, 2), b[3]) for b in batches]
        g = sum(np.concatenate([w * len(b[0]), p.ravel() * len(b[0])]) for (w, p), b in zip(parts_of, batches, strict=True)) / len(examples) - decay * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    field = Field(theta[:-4], theta[-4:].reshape(2, 2), 0.0, 0.0)
    means = np.array([np.dot(field.marginals(x), size) / size.sum() for x, size, _ in examples])
    return Field(field.weights, field.links, *logistic(means, np.array([y for _, _, y in examples])))


def fit_quality(documents: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE) -> Field:
    """A field from a sample of whole labelled documents of bounded size; only the features of their lines come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [line_features(t) for t in batch.column(1).to_pylist()]
            flat = [x.astype(np.float32).ravel() for x, _ in rows]
            size = [s.astype(np.float32) for _, s in rows]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(flat, pa.list_(pa.float32())), pa.array(size, pa.list_(pa.float32()))], ["doc_id", "label", "x", "size"])

    texts = stored(labelled_sample(documents, labels, "quality", sample).withColumn("n_lines", F.size(F.split("text", "\n", -1))), "quality-sample")
    rows = bounded(texts, "n_lines", FIT_LINES).select("doc_id", "text", "label").mapInArrow(run, "doc_id long, label int, x array<float>, size array<float>")
    got = rows.toArrow()
    order = np.argsort(got.column("doc_id").to_numpy(), kind="stable")
    x, size = (got.column(c).combine_chunks() for c in ("x", "size"))
    lines, ends, y = size.values.to_numpy(), size.offsets.to_numpy(), got.column("label").to_numpy()
    features = x.values.to_numpy().reshape(-1, N_FEATURES)
    return fit_field([(features[ends[k] : ends[k + 1]].astype(float), lines[ends[k] : ends[k + 1]].astype(float), int(y[k])) for k in order])


def score_quality(documents: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.array([field.score(t) for t in batch.column(2).to_pylist()], float)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = documents.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def keep_good(documents: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores threshold or more, with all their columns."""
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tables()
        for batch in batches:
            yield batch.filter(pa.array([field.score(t) >= threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
