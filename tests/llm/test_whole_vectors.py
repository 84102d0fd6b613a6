"""Toxicity looks for neighbours by all terms of a text, whichever label they go with and however many there are."""

import collections
import math

import numpy as np

from millrace.llm import toxicity

CLEAN = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe", "ri", "so", "tu") for b in ("ba", "de", "fi", "go", "hu", "la", "ne", "xo")]


def letters(k):
    return "".join(chr(97 + int(c)) for c in f"{k:04d}")


def examples(rng):
    """Clean texts of one vocabulary, and toxic ones that hold one of 700 words, each in two texts."""
    rows = [(i, " ".join(rng.choice(CLEAN, 40)), 0) for i in range(200)]
    rows += [(1000 + i, " ".join([*rng.choice(CLEAN, 3), f"vile{letters(i % 700)}", "kind" if i % 9 == 0 else "rude"]), 1) for i in range(1400)]
    return rows


def test_all_terms_count(spark):
    rng = np.random.default_rng(8)
    rows = examples(rng)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(9000, None), (9001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    index = toxicity.fit(docs, labels)
    words = {w for r in rows for w in r[1].split()}
    assert len(index.vocabulary) == len(words) and len(words) > 764
    texts = [(1, "so kind"), (2, f"vile{letters(699)} rude"), (3, f"vile{letters(0)}"), (4, " ".join(rng.choice(CLEAN, 40))), (5, "unseen words only"), (6, f"vile{letters(699)} " + " ".join(rng.choice(CLEAN, 8000)))]
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(texts, "doc_id long, text string"), index).collect()}
    # the two examples of a word are its nearest, whichever of 700 words it is
    assert {1000 + 699, 1700 + 699} <= set(got[2].evidence) and {1000, 1700} <= set(got[3].evidence)
    assert got[4].score < 0.1 < 0.9 < min(got[2].score, got[3].score) and all(d < 1000 for d in got[4].evidence)
    assert not got[5].evidence
    # one insult within many clean words is not the text that the insult is
    assert got[6].score < 0.5 < got[2].score


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    monkeypatch.setattr(toxicity, "FEW", 3)
    rng = np.random.default_rng(2)
    weights = 1 / np.arange(1, 65)
    rows = [(i, " ".join(rng.choice(CLEAN, int(rng.integers(1, 50)), p=weights / weights.sum())), int(rng.random() < 0.3)) for i in range(150)] + [(200, "?? 12", 0), (201, None, 1)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    index = toxicity.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    p = sum(r[2] for r in rows) / len(rows)
    held = [(i, collections.Counter("".join(c if c.isalpha() else " " for c in t or "").split()), y) for i, t, y in rows]
    n = collections.Counter(w for _, c, _ in held for w in c)
    a = collections.Counter(w for _, c, y in held for w in c if y)

    def weight(w):
        ratio = sum(x * math.log(x / e) for x, e in ((a[w], n[w] * p), (n[w] - a[w], n[w] * (1 - p))) if x)
        return math.sqrt(1 + 2 * max(ratio, 0)) * math.log(1 + len(rows) / (1 + n[w]))

    def vector(c):
        v = {w: (1 + math.log(k)) * weight(w) for w, k in c.items()}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / length for w, x in v.items()}

    vectors = {i: vector(c) for i, c, _ in held if c}
    got = {r.doc_id: r.evidence for r in toxicity.score(docs, index).collect()}
    assert got[200] == got[201] == []
    for i, v in vectors.items():
        similar = {j: sum(x * u.get(w, 0) for w, x in v.items()) for j, u in vectors.items()}
        third = sorted({round(x, 6) for x in similar.values()})[-3]  # examples of one vector count once
        assert all(similar[j] >= third - 1e-5 for j in got[i]), i
        assert len(got[i]) >= 3
