"""Quality rules as a learned decision list.

Statistics of whole texts, a fixed base rule, and then a list of rules learned by sequential covering from labelled
statistics: a rule is a conjunction of thresholds, grown condition by condition for the best information gain on two
thirds of the examples that no earlier rule covers, then pruned from its end on the other third. Rules are kept while
they are precise; each says "reject". The list becomes one Spark conditional expression, so applying it is plain SQL.

Defined results: null and empty texts have statistics of 0, fail the base rule and are not kept; repeated rows are
treated each; without labelled rows of both kinds the list is empty and only the base rule rejects.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import labelled_sample, words

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_exclaims", "n_digits")
#: What rules may test: each a ratio of two counts.
RATIOS = {
    "symbols_per_char": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "capital_share": ("n_capitals", "word_chars"),
    "exclaims_per_word": ("n_exclaims", "n_words"),
    "digit_share": ("n_digits", "word_chars"),
}
FEATURES = tuple(RATIOS)
WHITE = " \t\n\v\f\r"
SAMPLE = {0: 4000, 1: 8000}


def repeated_words(found: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text has twice or more."""
    windows = list(zip(found, found[1:], found[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times, total, covered = Counter(windows), 0, 0
    for i, window in enumerate(windows):  # covered: the words before this place that are counted
        if times[window] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def statistics(text: str | None) -> tuple[int, ...]:
    """The COUNTS of a text."""
    text = text or ""
    found = words(text)
    seen: set[str] = set()
    lines = duplicates = 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            lines += 1
            duplicates += line in seen
            seen.add(line)
    count = lambda chars: sum(map(text.count, chars))
    return len(found), len(text) - count(WHITE), count(SYMBOLS), duplicates, repeated_words(found), lines, count("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), text.count("!"), count("0123456789")


def text_statistics(documents: DataFrame, *kept: str) -> DataFrame:
    """The columns kept and the COUNTS of every whole text."""
    source = documents.select(*kept, "text")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]), *(f"{c} long" for c in COUNTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            columns = list(zip(*rows, strict=True)) or [[] for _ in COUNTS]
            yield pa.record_batch([*batch.columns[:-1], *(pa.array(c, pa.int64()) for c in columns)], [*kept, *COUNTS])

    return source.mapInArrow(run, schema)


def ratio(name: str) -> Column:
    over, under = RATIOS[name]
    return F.coalesce(F.try_divide(F.col(over).cast("double"), F.col(under).cast("double")), F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        values = x[:, FEATURES.index(self.feature)]
        return values >= self.threshold if self.at_least else values <= self.threshold

    def column(self) -> Column:
        return ratio(self.feature) >= self.threshold if self.at_least else ratio(self.feature) <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for c in rule:
        hit &= c.holds(x)
    return hit


def best_condition(x: np.ndarray, bad: np.ndarray) -> Condition | None:
    """The threshold with the greatest FOIL gain on these examples, if one gains anything."""
    total_bad, total = int(bad.sum()), len(bad)
    if not total_bad or total_bad == total:
        return None
    base, best, found = np.log2(total_bad / total), 1e-9, None
    for k, feature in enumerate(FEATURES):
        order = np.argsort(x[:, k], kind="stable")
        values, hits = x[order, k], np.cumsum(bad[order])
        cuts = np.flatnonzero(values[1:] > values[:-1])  # between cuts[i] and the next value
        if not len(cuts):
            continue
        below_bad, below = hits[cuts], cuts + 1
        for at_least, p, n in ((False, below_bad, below), (True, total_bad - below_bad, total - below)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / n) - base), -np.inf)
            i = int(np.argmax(gain))
            if gain[i] > best:
                best, found = gain[i], Condition(feature, at_least, float((values[cuts[i]] + values[cuts[i] + 1]) / 2))
    return found


def learn_rules(x: np.ndarray, bad: np.ndarray, precision: float = 0.9, least: int = 5, most_rules: int = 20, most_conditions: int = 4) -> list[Rule]:
    """Sequential covering. x: a row of FEATURES for each example; bad: which to reject."""
    rules: list[Rule] = []
    growing = np.arange(len(x)) % 3 != 2
    left = np.ones(len(x), bool)
    while len(rules) < most_rules and (left & growing & bad).sum() >= least:
        rule: Rule = ()
        inside = left & growing
        while len(rule) < most_conditions and (c := best_condition(x[inside], bad[inside])):
            rule += (c,)
            inside = inside & c.holds(x)
            if bad[inside].all():
                break
        check = left & ~growing

        def worth(r: Rule, check=check) -> float:
            hit = covers(r, x) & check
            return (2 * (bad & hit).sum() - hit.sum()) / max(1, hit.sum())

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = covers(rule, x) & left
        if not rule or hit.sum() < least or bad[hit].mean() < precision:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def fit_rules(documents: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE) -> list[Rule]:
    """Rules from a sample of labelled documents of bounded size; only its statistics come to the driver."""
    rows = text_statistics(labelled_sample(documents, labels, "quality", sample), "doc_id", "label")
    got = rows.select("doc_id", "label", *(ratio(f).alias(f) for f in FEATURES)).toPandas().sort_values(["label", "doc_id", *FEATURES])
    return learn_rules(got[list(FEATURES)].to_numpy(float), got["label"].to_numpy() == 0)


def rules_column(rules: list[Rule]) -> Column:
    """True where no rule of the list rejects."""
    verdict = None
    for rule in rules:
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        verdict = F.when(test, F.lit(False)) if verdict is None else verdict.when(test, F.lit(False))
    return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))


def apply_rules(documents: DataFrame, rules: list[Rule]) -> DataFrame:
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = text_statistics(documents, "doc_id")
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & rules_column(rules)).alias("kept"))
