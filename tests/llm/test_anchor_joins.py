"""Blocks of rows and anchors meet without passing through the driver."""

import numpy as np

from millrace.llm import hard_negatives


def test_nothing_is_broadcast(spark, monkeypatch):
    asked = []
    arrow = hard_negatives.in_arrow
    monkeypatch.setattr(hard_negatives, "in_arrow", lambda df, run, schema: asked.append(df) or arrow(df, run, schema))
    rng = np.random.default_rng(1)
    rows = [(i, int(rng.integers(3)), [float(x) for x in rng.normal(0.3, 0.4, 4)]) for i in range(300)]
    out = hard_negatives.hard_negatives(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), 20)
    assert out.count() > 0
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in [*asked, out]]
    assert sum("SortMergeJoin" in p for p in plans) >= 3 and not any("Broadcast" in p for p in plans)
