"""Every word is a context of the language model, not only the most frequent ones."""

import collections

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import language_model


def rows_of(rng, names, n):
    """Texts of pairs: the first word of a pair decides the second, and no word is frequent."""
    return [" ".join(f"{names[k]} {names[k][::-1]}" for k in rng.integers(0, len(names), 40)) for _ in range(n)]


def test_rare_words_are_contexts(spark):
    rng = np.random.default_rng(9)
    names = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 9)) for _ in range(300)]
    texts = rows_of(rng, names, 300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = language_model.scored(docs, F.col("doc_id") % 10 == 0).filter("held_out").collect()
    # 40 of 81 tokens are drawn from 300 words and ends; the others are nearly certain
    assert len(got) == 30 and all(r.n_tokens == 81 for r in got)
    assert sum(r.score for r in got) / len(got) > -1.35 * 41 * np.log10(300)
    turned = spark.createDataFrame([(k, " ".join(reversed(t.split())) if k == 0 else t) for k, t in enumerate(texts)], "doc_id long, text string")
    other = language_model.scored(turned, F.col("doc_id") % 10 == 0).filter("doc_id = 0").first()
    mine = next(r for r in got if r.doc_id == 0)
    assert other.score < mine.score - 40 and abs(other.base_score - mine.base_score) < 1e-6


def test_scores_do_not_hang_on_batches(spark, monkeypatch):
    """Counts by cell are the same however texts are dealt; the seatings drawn too, since a bucket's cells are."""
    rng = np.random.default_rng(3)
    names = [f"w{k}" for k in range(40)]
    texts = [" ".join(rng.choice(names, int(n))) for n in rng.integers(0, 60, 120)] + [None, "", "w1 w1 w1"]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "w1 w2")] * 2, "doc_id long, text string")
    told = []
    for size, parts in ((8 << 20, 1), (300, 7)):
        monkeypatch.setattr(language_model, "BATCH_BYTES", size)
        out = language_model.scored(docs.repartition(parts), F.col("doc_id") % 5 == 0).collect()
        told.append(collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 4)) for r in out))
    assert told[0] == told[1] and sum(told[0].values()) == 125


def test_many_buckets(spark, monkeypatch):
    """Contexts are added up over all buckets: each cell's context has its true totals, whatever the number of buckets."""
    rng = np.random.default_rng(4)
    names = [f"w{k}" for k in range(50)]
    docs = spark.createDataFrame([(k, " ".join(rng.choice(names, 60))) for k in range(100)], "doc_id long, text string")
    means = []
    for size in (8 << 20, 500):
        monkeypatch.setattr(language_model, "BUCKET_BYTES", size)
        out = {r.doc_id: r.score / r.n_tokens for r in language_model.scored(docs, F.col("doc_id") % 5 == 0).collect()}
        assert len(out) == 100
        means.append(out)
    off = [abs(means[0][k] - means[1][k]) / abs(means[0][k]) for k in means[0]]
    assert sum(off) / len(off) < 0.01


def test_chances_of_one_customer_each(spark):
    """Where every word follows its context once, all tables of the contexts are known: the chances add up as the rule has them."""
    docs = spark.createDataFrame([(0, "a b c d"), (1, "b a")], "doc_id long, text string")
    got = {r.doc_id: r for r in language_model.scored(docs, F.col("doc_id") == 1).collect()}
    # five contexts of one customer and one table; the parent has five words of one customer and table each
    d, e, s = language_model.DISCOUNT, language_model.PARENT_DISCOUNT, language_model.STRENGTH
    parent = (1 - e + (s + e * 5) / 6) / (s + 5)
    known = (1 - d + (s + d) * parent) / (s + 1)
    new = (s + d) * parent / (s + 1)
    assert abs(got[0].score - 5 * np.log10(known)) < 1e-5
    assert abs(got[1].score - 3 * np.log10(new)) < 1e-5
