"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._arrow import in_arrow
from millrace.llm._scratch import stored

#: Edges that one task may hold; a few hundred bytes each.
FEW_EDGES = 300_000


def _in_one_task(batches):
    """Union and find with the smallest node on top."""
    above, kinds = {}, None

    def top(x):
        while above[x] != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for batch in batches:
        kinds = batch.schema.field("a").type
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = top(above.setdefault(a, a)), top(above.setdefault(b, b))
            above[max(a, b)] = min(a, b)
    if above:
        nodes = list(above)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, kinds), pa.array([top(x) for x in nodes], kinds)], ["node", "component"])


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Each node with the smallest of itself and its neighbours; counted partially, so a hub is no hot task."""
    return edges.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; a component is named by its smallest node.

    Large-star links every larger neighbour of a node to the node's least neighbour, small-star links the
    smaller ones. Both keep components as they are, and after a number of rounds that grows with the
    logarithm of the number of nodes every node hangs on its component's least node. Rounds end when the
    edges stay the same; each is written to the shared folder. Rows with a NULL end and loops are left out.
    At most ``FEW_EDGES`` edges are no work for rounds of jobs: one task joins them, with the same result.
    """
    edges = edges.select("a", "b").filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    if edges.count() <= FEW_EDGES:
        kind = edges.schema["a"].dataType.simpleString()
        return in_arrow(edges.coalesce(1), _in_one_task, f"node {kind}, component {kind}")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_least_neighbour(both), "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct()
        large = stored(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.*")
        edges = stored(small.filter("a <> b").distinct(), "small-star")
        # a node's mark folds its edges into one number: equal sums of all edges mean equal edge sets
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = now
