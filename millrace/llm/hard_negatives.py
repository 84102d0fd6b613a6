"""Hard negatives of anchors: rows of another label that score just below the anchor's positives.

The upper limits of an anchor's positives cut the scores into disjoint slots. Cells of a block of rows and a block of
anchors keep the best rows of each slot; a positive's answer is merged from its own slot and all lower ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm._arrow import in_arrow
from millrace.llm._scratch import shuffle_width, stored

#: Every so manieth id is an anchor; its first positives; negatives of each; their scores in hundredths of the positive's.
EVERY, POSITIVES, NEGATIVES, LOW, HIGH = 100, 5, 10, 30, 90
#: Components are whole numbers of this part of one.
SCALE = 256
#: Rows of a block, which is one row of a table; rows and anchors that meet under one key of the join at most, about.
BLOCK, STRIPE_ROWS, STRIPE_ANCHORS = 1024, 1 << 20, 1 << 17

_LEAST = np.iinfo(np.int64).min


def _whole_numbers(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a usable vector, and those vectors in whole numbers; shorter ones end in zeros."""
    column = column.cast(pa.list_(pa.float64()))
    sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), column.value_lengths().fill_null(0).to_numpy(), 0)
    values = column.flatten()
    flat = np.floor(values.fill_null(float("nan")).to_numpy(zero_copy_only=False) * scale)
    row = np.repeat(np.arange(len(sizes)), sizes)
    good = column.is_valid().to_numpy(zero_copy_only=False) & (np.bincount(row, ~np.isfinite(flat), len(sizes)) == 0)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    fine = good[row]
    out[row[fine], place[fine]] = flat[fine]
    return good, out[good]


def _packed(rows: DataFrame, scale: int) -> DataFrame:
    """``ids, labels, limits, lows, vectors, narrow, width``: blocks of rows as bytes. Vectors of small numbers take 4 bytes a component."""

    def run(batches):
        for batch in batches:
            good, vectors = _whole_numbers(batch.column("vector"), scale)
            ids, labels = (batch.column(c).to_numpy()[good] for c in ("id", "label"))
            limits, lows = (batch.column(c).filter(pa.array(good)) for c in ("limits", "low"))
            for at in range(0, len(ids), BLOCK):
                some = slice(at, at + BLOCK)
                narrow = bool(np.abs(vectors[some]).max(initial=0) < 1 << 24)
                given = [x or () for x in limits[some].to_pylist()]
                bounds = np.full((len(given), max(1, max(map(len, given)))), _LEAST)
                for k, x in enumerate(given):
                    bounds[k, : len(x)] = x
                low = lows[some].fill_null(0).to_numpy()
                columns = [x.tobytes() for x in (ids[some], labels[some], bounds, low, vectors[some].astype(np.float32 if narrow else np.float64))]
                yield pa.RecordBatch.from_arrays([*(pa.array([c], pa.binary()) for c in columns), pa.array([narrow]), pa.array([vectors.shape[1]], pa.int32())], ["ids", "labels", "limits", "lows", "vectors", "narrow", "width"])

    return in_arrow(rows, run, "ids binary, labels binary, limits binary, lows binary, vectors binary, narrow boolean, width int")


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids, labels, lows = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "lows"))
    vectors = np.frombuffer(row["vectors"], np.float32 if row["narrow"] else np.float64).reshape(len(ids), row["width"])
    return ids, labels, np.frombuffer(row["limits"], np.int64).reshape(len(ids), -1), lows, vectors


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in the narrowest floats that hold every partial sum, else in Python's integers.

    A product that no long holds counts as the nearest long.
    """
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, width)
    if most < 1 << 53:
        kind = np.float32 if most < 1 << 24 else np.float64
        return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    whole = [np.vectorize(int, otypes=[object])(x) if x.size else x.astype(object) for x in (a, b)]
    return np.clip(whole[0] @ whole[1].T, _LEAST + 1, np.iinfo(np.int64).max).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, group: np.ndarray, open_: np.ndarray, k: int, bar: np.ndarray) -> tuple[np.ndarray, ...]:
    """The first ``k`` open cells of each group by score descending, then id: group, column and score of each.

    ``bar``: by group, a score that ``k`` rows are known to reach; raised here.
    """
    row, column = np.nonzero(open_ & (scores >= bar[group]))
    g, s = group[row, column], scores[row, column]
    order = np.lexsort((ids[column], -s, g))
    g, s, column = g[order], s[order], column[order]
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, int)
    place = np.arange(len(g)) - np.repeat(first, np.diff(np.append(first, len(g))))
    full = place == k - 1
    bar[g[full]] = np.maximum(bar[g[full]], s[full])
    keep = place < k
    return g[keep], column[keep], s[keep]


def _met(rows: DataFrame, anchors: DataFrame, stripes: int, parts: int, positives: int, k: int, same_label: bool) -> DataFrame:
    """``anchor_id, slot, vec_id, score``: of every cell of a block of rows and one of anchors, the best of each slot.

    Each block of rows goes to one stripe and to every part of the anchors, each block of anchors to one part and to every
    stripe. A task remembers, of the anchors it has met, what score is enough, so that later cells send little.
    """

    def run(batches):
        bars: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, _, _, vectors = _unpacked(row["r"])
                anchor_ids, anchor_labels, limits, lows, anchor_vectors = _unpacked(row["a"])
                bar = bars.setdefault(row["a"]["ids"], np.full(len(anchor_ids) * positives, _LEAST))
                scores = _scores(anchor_vectors, vectors)
                open_ = (anchor_labels[:, None] == labels) == same_label
                open_ &= anchor_ids[:, None] != ids
                slot = np.zeros(scores.shape, np.int64)
                if not same_label:
                    open_ &= (scores <= limits[:, :1]) & (scores >= lows[:, None])
                    for n in range(1, limits.shape[1]):
                        slot += scores <= limits[:, n : n + 1]
                group = slot + np.arange(len(anchor_ids))[:, None] * positives
                g, column, s = _best(scores, ids, group, open_, k, bar)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor_ids[g // positives], (g % positives).astype(np.int32), ids[column], s)], ["anchor_id", "slot", "vec_id", "score"])

    spread = lambda df, own, others: df.select(F.struct(*df.columns).alias("x"), F.pmod(F.xxhash64("ids"), F.lit(own)).alias("own"), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("other"))
    left = spread(rows, stripes, parts).select(F.col("own").cast("int").alias("stripe"), F.col("other").alias("part"), F.col("x").alias("r"))
    right = spread(anchors, parts, stripes).select(F.col("other").alias("stripe"), F.col("own").cast("int").alias("part"), F.col("x").alias("a"))
    # the copies for all stripes do not show in Spark's size estimate, so it would broadcast them through the driver
    found = in_arrow(left.join(right.hint("merge"), ["stripe", "part"]).select("r", "a"), run, "anchor_id long, slot int, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("place", place).filter(F.col("place") <= k)


def _percent(score, percent: int, up: bool):
    """percent * score / 100 rounded down or up, of scores from 0; no step leaves the range of a long."""
    div = lambda a: F.call_function("div", a, F.lit(100).cast("long"))
    return div(score) * percent + div(score % 100 * percent + (99 if up else 0))


def hard_negatives(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """The best rows of other labels whose scores are ``low`` to ``high`` hundredths of those of an anchor's positives.

    Takes ``vec_id, label, embedding`` (other columns are ignored) and returns ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``. A row takes no part with a NULL vec_id or label, a NULL vector, or a component that is
    NULL or not finite. Each component x becomes floor(scale * x), a score is the inner product of two rows; of vectors
    of different length the shorter one ends in zeros. Higher scores come first, ties by smaller vec_id.

    Anchors are the vec_ids divisible by ``every``; of repeated ones the one with the smallest label and vector. Rows with an
    anchor's own vec_id are neither its positives nor its negatives; any other repeated row is a row more. Positives are
    the first ``positives`` rows of the anchor's label, all if there are fewer; a positive with a score below 0,
    or without such negatives, has no row. Every row meets every anchor; nothing is approximate. An empty table gives no row.
    """
    if positives < 1 or not 0 <= low <= high <= 100:
        raise ValueError("positives must be 1 or more, and low and high hundredths in order")
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("vector")).filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    bounds = [F.lit(None).cast("array<long>").alias("limits"), F.lit(None).cast("long").alias("low")]
    rows = stored(_packed(vectors.select("id", "label", "vector", *bounds), scale), "vector-blocks")
    # a repeated anchor's row must be usable, so that is asked before one of them is taken
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    anchors = vectors.filter((F.pmod("id", F.lit(every)) == 0) & usable).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("x")).select("id", "x.label", "x.vector")
    anchors = stored(anchors, "anchors")
    n, m, width = vectors.count(), anchors.count(), shuffle_width(spark)
    parts = max(1, -(-m // STRIPE_ANCHORS))
    stripes = max(1, -(-n // STRIPE_ROWS), min(-(-width // parts), -(-n // BLOCK)))
    first = _met(rows, _packed(anchors.select("*", *bounds), scale), stripes, parts, 1, positives, True)
    first = first.filter("score >= 0").select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), (F.col("place") - 1).alias("slot"))
    first = first.withColumn("limit", _percent(F.col("positive_score"), high, False)).withColumn("low", _percent(F.col("positive_score"), low, True))
    first = stored(first, "positives")
    limits = first.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list("limit"), asc=False).alias("limits"), F.min("low").alias("low"))
    found = _met(rows, _packed(anchors.join(limits.hint("merge"), "id").select("id", "label", "vector", "limits", "low"), scale), stripes, parts, positives, negatives, False)
    found = found.select("anchor_id", F.col("slot").alias("found_slot"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    # a positive's window is its own slot and all lower ones, down to its low limit
    merged = first.join(found.hint("merge"), "anchor_id").filter("found_slot >= slot AND negative_score >= low")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "slot").orderBy(F.desc("negative_score"), "negative_id"))
    merged = merged.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    return merged.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
