"""Turns of the set-similarity join: no more than pay, with every link found."""

import random

from millrace.llm import jaccard_join


def test_few_open_pairs_are_compared_at_once(spark, monkeypatch):
    rng = random.Random(7)
    rows = []
    for chain in range(12):  # each text is like the one before it, not like the first one
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        for _ in range(9):
            rows.append((len(rows), " ".join(words)))
            words = words[2:] + [f"w{rng.randrange(10**6)}" for _ in range(2)]
    turns = []
    plain = jaccard_join._hub_pairs
    monkeypatch.setattr(jaccard_join, "_hub_pairs", lambda lists, turn, percent: turns.append(turn) or plain(lists, turn, percent))
    found = jaccard_join.near_duplicate_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i - i % 9 for i, _ in rows}
    assert turns == [0]
