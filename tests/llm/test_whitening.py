"""Whitening against exact rational arithmetic."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tracewell.llm import whitening

ROWS = "vec_id long, embedding array<float>, label int, x string, key string, n int, whitened int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", "k", 2, 3) for i, v in vectors], ROWS)


def exact(vectors):
    """The fit list's integers, n * x - S of each row, and the covariance as fractions."""
    good = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in vectors]
    fit = sorted({tuple(x) for _, x in good})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    y = [[n * x[j] - sums[j] for j in range(d)] for x in fit]
    v = [[Fraction(sum(r[i] * r[j] for r in y), n**3) for j in range(d)] for i in range(d)]
    return good, n, sums, v


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(12)
    mixed = rng.normal(size=(300, 6)) * [30, 10, 3, 1, 0.5, 0.2] @ rng.normal(size=(6, 6)) + 5
    rows = [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(mixed)]
    return [*rows, *((1000 + i, rows[0][1]) for i in range(50)), (3, rows[7][1]), (None, rows[8][1])]


def test_double_double_sums_are_nearly_exact():
    rng = random.Random(1)
    x = np.array([[rng.randrange(-(10**9), 10**9) + 10**12 for _ in range(5)] for _ in range(1000)], np.int64)
    sums = x.sum(axis=0).tolist()
    high = np.array([s / 1000 for s in sums])
    low = np.array([float(Fraction(s, 1000) - Fraction(h)) for s, h in zip(sums, high.tolist())])
    own = whitening.Covariance((high, low))
    own.update(x)
    for i in range(5):
        for j in range(i, 5):
            want = sum((Fraction(a, 1) - Fraction(sums[i], 1000)) * (Fraction(b, 1) - Fraction(sums[j], 1000)) for a, b in zip(x[:, i].tolist(), x[:, j].tolist()))
            got = Fraction(own.high[i, j]) + Fraction(own.low[i, j])
            assert abs(got - want) <= abs(want) * Fraction(1, 10**26)


def test_error_free_transformations():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=100) * 10.0 ** rng.integers(-8, 8, 100), rng.normal(size=100)
    s, e = whitening.two_sum(a, b)
    assert all(Fraction(p) + Fraction(q) == Fraction(x) + Fraction(y) for p, q, x, y in zip(a, b, s, e))
    high, low = whitening.split(a)
    assert (high + low == a).all() and all(Fraction(h) ** 2 == Fraction(h * h) for h in high)


def test_whitening_equals_exact_arithmetic(spark, vectors):
    odd = [(1, None), (2, []), (3, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (4, [float("nan")] + [0.0] * 5), (5, [float("inf")] + [0.0] * 5), (6, [1.0, 2.0]), (7, [1e30] + [0.0] * 5)]
    good, n, sums, v = exact(vectors)
    cov = np.array([[float(c) for c in r] for r in v])
    values, components = np.linalg.eigh(cov)
    values, components = values[::-1], components[:, ::-1]
    rows = whitening.whiten(frame(spark, [*odd, *vectors])).collect()
    assert len(rows) == 6 * len(good) and {r["component"] for r in rows} == {1, 2, 3, 4, 5, 6}
    found = {}
    for r in rows:
        found.setdefault((r["vec_id"], r["component"]), []).append(r)
    trace = float(sum(v[i][i] for i in range(6)))
    signs = {}
    for i, x in good:
        y = [n * c - s for c, s in zip(x, sums)]
        for k in range(6):
            want = sum(float(Fraction(c, n)) * components[j, k] for j, c in enumerate(y)) / math.sqrt(values[k])
            near = [r for r in found[i, k + 1] if r["deviation"] == sum(c * c for c in y)]
            assert near and near[0]["n"] == n
            sign = signs.setdefault(k, 1 if near[0]["whitened"] * want > 0 else -1) if abs(want) > 0.01 else signs.get(k)
            assert sign is None or abs(sign * near[0]["whitened"] - want) < 1e-7 * max(1, abs(want))
            assert abs(near[0]["explained"] - values[k] / trace) <= 1e-9 * values[k] / trace
            assert near[0]["identity_error"] < 1e-9


def test_few_directions(spark):
    flat = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(10)])).collect()
    assert all(r["whitened"] is not None and r["explained"] > 0.999 for r in flat if r["component"] == 1)
    assert all(r["whitened"] is None and r["explained"] == 0 for r in flat if r["component"] > 1)
    same = whitening.whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(3)])).collect()
    assert len(same) == 6 and all((r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (1, 0, None, None, None) for r in same)
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).count() == 0


def test_deviations_beyond_64_bits(spark):
    rows = whitening.whiten(frame(spark, [(i, [float(2**36 * i), 1.0]) for i in range(4)])).collect()
    good, n, sums, _ = exact([(i, [float(2**36 * i), 1.0]) for i in range(4)])
    want = {i: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for i, x in good}
    assert all(r["deviation"] == (want[r["vec_id"]] if want[r["vec_id"]] < 2**63 else None) for r in rows)


def test_merging_many_tasks(spark, vectors):
    one = {(r["vec_id"], r["component"], r["deviation"]): abs(r["whitened"]) for r in whitening.whiten(frame(spark, vectors).coalesce(1)).collect()}
    many = {(r["vec_id"], r["component"], r["deviation"]): abs(r["whitened"]) for r in whitening.whiten(frame(spark, vectors).repartition(40)).collect()}
    assert one.keys() == many.keys() and all(abs(one[k] - many[k]) < 1e-9 * max(1, one[k]) for k in one)
