"""Hard negatives beside brute force in Python's integers."""

import collections
import math

import numpy as np
import pytest

from millrace.llm import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<double>, score double, slot string, `id` int"


def frame(spark, rows):
    return spark.createDataFrame([(i, y, v, 0.0, "x", 1) for i, y, v in rows], SCHEMA)


def brute_force(rows, every=100, positives=5, negatives=10, low=30, high=90, scale=256):
    fine = [(i, y, tuple(math.floor(scale * x) for x in v)) for i, y, v in rows if None not in (i, y, v) and all(x is not None and math.isfinite(x) for x in v)]
    vectors = {}
    for (i, y, v), raw in zip(fine, [v for i, y, v in rows if None not in (i, y, v) and all(x is not None and math.isfinite(x) for x in v)]):
        if i % every == 0:
            vectors[i] = min(vectors.get(i, (y, raw, v)), (y, raw, v))
    out = []
    for a, (y, _, v) in vectors.items():
        others = [(-sum(p * q for p, q in zip(v, w)), i, z) for i, z, w in fine if i != a]
        same = sorted((s, i) for s, i, z in others if z == y)[:positives]
        for s, i in same:
            fit = sorted((t, j) for t, j, z in others if z != y and low * -s <= 100 * -t <= high * -s)[:negatives]
            out += [(a, i, k + 1, j, -s, -t) for k, (t, j) in enumerate(fit)]
    return collections.Counter(out)


def found(df):
    return collections.Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def random_rows(rng, n, width, labels):
    return [(i, int(rng.integers(labels)), [float(x) for x in np.round(rng.normal(0.3, 0.4, width), 1)]) for i in range(n)]


@pytest.mark.parametrize("n, every, width, labels", [(300, 20, 6, 4), (120, 7, 2, 3), (60, 3, 1, 1)])
def test_equals_brute_force(spark, monkeypatch, n, every, width, labels):
    # coarse values give many ties; small blocks give many cells
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    rows = random_rows(np.random.default_rng(n), n, width, labels)
    want = brute_force(rows, every)
    assert found(hard_negatives.hard_negatives(frame(spark, rows).repartition(3), every)) == want
    monkeypatch.setattr(hard_negatives, "STRIPE_ROWS", 40)
    monkeypatch.setattr(hard_negatives, "STRIPE_ANCHORS", 5)
    assert found(hard_negatives.hard_negatives(frame(spark, rows).repartition(3), every)) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = random_rows(np.random.default_rng(2), 150, 4, 3)
    rows += [(100, None, [1.0] * 4), (None, 1, [1.0] * 4), (200, 1, None), (201, 1, [1.0, None, 1.0, 1.0]), (202, 1, [nan] * 4), (203, 2, [inf, 0.0, 0.0, 0.0])]
    rows += [(300, 1, []), (301, 1, [2.0]), (400, 2, [0.5] * 9), (500, 0, [-1.0] * 4), (600, 1, [0.0] * 4), (-700, 1, [1.0] * 4)]
    rows += [(31, 1, [0.9] * 4)] * 3 + [(100, 2, [0.7] * 4), (100, 0, [0.8] * 4)]  # repeated rows; an anchor under several labels
    assert found(hard_negatives.hard_negatives(frame(spark, rows))) == brute_force(rows)
    assert hard_negatives.hard_negatives(frame(spark, [])).count() == 0
    assert hard_negatives.hard_negatives(frame(spark, [(0, 1, [1.0])])).count() == 0


def test_other_windows_and_large_numbers(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 3, [float(x) for x in rng.normal(0, 10.0 ** int(rng.integers(0, 7)), 3)]) for i in range(200)]
    assert found(hard_negatives.hard_negatives(frame(spark, rows), 10, 3, 4, 0, 100, 1000)) == brute_force(rows, 10, 3, 4, 0, 100, 1000)
    large = [(i, y, [x * 33 for x in v]) for i, y, v in rows if max(map(abs, v)) < 1e5]
    assert found(hard_negatives.hard_negatives(frame(spark, large), 10)) == brute_force(large, 10)


def test_scores_are_exact():
    rng = np.random.default_rng(1)
    for size in (100, 1 << 23, 1 << 30):
        a, b = (rng.integers(-size, size, (5, 3)).astype(np.float64) for _ in range(2))
        want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
        assert hard_negatives._scores(a, b).tolist() == want
    assert hard_negatives._scores(np.array([[1e30]]), np.array([[1e30], [-1e30]])).tolist() == [[2**63 - 1, -(2**63) + 1]]
