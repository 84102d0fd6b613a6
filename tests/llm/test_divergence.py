"""Divergences of sources beside brute force in whole numbers."""

import collections
import re

import numpy as np
import pytest

from millrace.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n double, total string"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, lang, s, "x", 0.5, None) for k, (t, lang, s) in enumerate(rows)], SCHEMA)


def brute_force(rows, top=200, least=3):
    low = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})
    docs, counts, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(low))
        docs.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
    share = lambda c, n, v: 1 + 1_000_000_000 * (c + 1) // (n + v)
    apart = lambda p, q: (p - q) ** 2 // q
    out = []
    for lang, source in groups:
        kept = sorted(t for (x, t), n in docs.items() if x == lang and n >= least)
        total = lambda s: sum(counts[lang, s, t] for t in kept)  # noqa: E731, B023
        peers = [s for x, s in groups if x == lang]
        pairs = [(s, sum(apart(share(counts[lang, source, t], total(source), len(kept)), share(counts[lang, s, t], total(s), len(kept))) for t in kept)) for s in peers if s != source]
        whole = sum(total(s) for s in peers)
        tell = []
        for t in kept:
            c, n = counts[lang, source, t], sum(counts[lang, s, t] for s in peers)
            p, q = share(c, total(source), len(kept)), share(n, whole, len(kept))
            if c and p > q:
                tell.append((t, apart(p, q)))
        for part, items in (("pair", pairs), ("term", tell)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[: top if part == "term" else None]
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


def found(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in df.collect())


def corpus(rng, sources):
    words = ["Haus", "baum", "été", "x", "naïve", "Ünder", "東京", "zeta", "a_b", "it's", "3d", "über", "KelvinK", "zß"] + [f"t{chr(97 + a)}{chr(97 + b)}" for a in range(6) for b in range(6)]
    rows = []
    for s in range(sources):
        for lang in ("en", "de", None)[: 1 + s % 3]:
            for _ in range(int(rng.integers(1, 5))):
                rows.append((" ".join(rng.choice(words, int(rng.integers(0, 30)))), lang, f"s{s}" if s else None))
    return rows


def test_equals_brute_force(spark):
    rows = corpus(np.random.default_rng(0), 12)
    rows += [(None, "en", "empty"), ("", None, None), ("12 34 %", "fr", "one"), ("seul", "fr", "one"), ("much " * 30_000, "en", "s1"), rows[0], rows[0]]
    rows += [("only here", "it", "alone")] * 3
    assert found(divergence.divergences(frame(spark, rows).repartition(4))) == brute_force(rows)
    assert divergence.divergences(frame(spark, [])).count() == 0


@pytest.mark.parametrize("sources, terms", [(3, 5), (1, 50), (1000, 1)])
def test_blocks_do_not_change_the_result(spark, monkeypatch, sources, terms):
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", sources)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", terms)
    rows = corpus(np.random.default_rng(7), 9) + [(None, "en", "empty"), ("", "en", "empty2")]
    assert found(divergence.divergences(frame(spark, rows), top=7)) == brute_force(rows, top=7)


def test_shares_do_not_overflow():
    big = 9 * 10**14
    got = divergence._shares(np.array([0, 5, big]), np.array([big, 7 * 10**12, big]), 10**9)
    assert got.tolist() == [1 + 1_000_000_000 * (c + 1) // (n + 10**9) for c, n in ((0, big), (5, 7 * 10**12), (big, big))]
