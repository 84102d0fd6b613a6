"""Benchmark passages in documents by spaced seeds; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed masks over successive words; a word under 0 is ignored, so a substitution there does not hide the hit.
MASKS = ("110110011", "1011001101")
#: A verified overlap has at least so many equal words, and this share of equal words. Of an item with fewer words it has this
#: share of the item's; an item too short for a mask is there only as a whole.
LEAST_WORDS = 13
LEAST_SHARE = 0.75
#: Words a mask spans at least.
SPAN = min(len(m) for m in MASKS)
#: Cost of a substituted word when an overlap is extended; an equal word gains 1.
SUBSTITUTION = 2
#: Seeds of the benchmark that a broadcast may hold; beyond it both sides are shuffled by seed.
BROADCAST_SEEDS = 500_000


def words_of(text: Column) -> Column:
    """Runs of letters and digits, lower-cased; NULL has none."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _seeds(rows: DataFrame, keys: list[str], whole: list[int] = []) -> DataFrame:
    """``keys, words, at, seed`` for each place and mask of the array ``words``, and for the runs of ``whole`` words from each place."""
    least = min([SPAN, *whole])
    places = F.expr(f"CASE WHEN size(words) >= {least} THEN sequence(0, size(words) - {least}) END")
    placed = rows.select(*keys, "words", F.explode_outer(places).alias("at"))
    hashes = [
        F.expr(f"xxhash64({k}, " + ", ".join(f"get(words, at + {i})" for i, x in enumerate(mask) if x == "1") + ")") for k, mask in enumerate(MASKS)
    ]
    if whole:
        hashes = [F.when(F.col("at") + SPAN <= F.size("words"), h) for h in hashes] + [F.when(F.col("at") + m <= F.size("words"), _whole_seed(m, F.col("at"))) for m in whole]
    return placed.select(*keys, "words", "at", F.explode_outer(F.array(*hashes)).alias("seed")).filter("at IS NOT NULL AND seed IS NOT NULL")


def _whole_seed(m: int, at: Column) -> Column:
    return F.xxhash64(F.lit(-m), *[F.get("words", at + i) for i in range(m)])


def _item_seeds(items: DataFrame) -> tuple[DataFrame, list[int]]:
    """``item_id, item_key, item_words, item_at, seed`` of all items, and the lengths of those too short for a mask."""
    short = [r[0] for r in items.filter((F.size("words") > 0) & (F.size("words") < SPAN)).select(F.size("words")).distinct().collect()]
    seeds = _seeds(items, ["item_id", "item_key"])
    for m in short:
        own = items.filter(F.size("words") == m).select("item_id", "item_key", "words", F.lit(0).alias("at"), _whole_seed(m, F.lit(0)).alias("seed"))
        seeds = seeds.unionByName(own)
    return seeds.select("item_id", "item_key", F.col("words").alias("item_words"), F.col("at").alias("item_at"), "seed"), sorted(short)


def _hits(rows: DataFrame, seeds: DataFrame, short: list[int]) -> DataFrame:
    """``doc_id, text_key, item_id, shift, words, item_words`` of the alignments that some seed fixes.

    Few seeds go to where the documents are. Many meet the documents' seeds by a shuffle, and then only places travel with these;
    the words are fetched for what has met.
    """
    shift = (F.col("at") - F.col("item_at")).alias("shift")
    placed = _seeds(rows, ["doc_id", "text_key"], short)
    if seeds.count() <= BROADCAST_SEEDS:
        return placed.join(F.broadcast(seeds), "seed").select("doc_id", "text_key", "item_id", shift, "words", "item_words")
    thin = placed.select("doc_id", "text_key", "at", "seed").join(seeds.drop("item_words"), "seed")
    met = thin.select("doc_id", "text_key", "item_id", "item_key", shift).distinct()
    items = seeds.select("item_id", "item_key", "item_words").dropDuplicates(["item_id", "item_key"])
    met = met.withColumnsRenamed({"doc_id": "own_id", "text_key": "own_key", "item_id": "own_item", "item_key": "own_item_key"})
    met = met.join(items, F.col("own_item").eqNullSafe(F.col("item_id")) & (F.col("own_item_key") == F.col("item_key")))
    found = met.join(rows, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key")))
    return found.select("doc_id", "text_key", "item_id", "shift", "words", "item_words")


def _extended(flags: Column) -> Column:
    """The stretch of ``flags`` with the best score, as ``matched, first, last``: each equal word 1, each other -SUBSTITUTION."""
    start = F.struct(
        *[F.lit(0).alias(x) for x in ("i", "score", "equal", "begin", "best", "matched", "first")], F.lit(-1).alias("last")
    )

    def step(s, same):
        score = s["score"] + F.when(same, 1).otherwise(-SUBSTITUTION)
        fresh = s["score"] <= 0
        score = F.when(fresh, F.when(same, 1).otherwise(0)).otherwise(score)
        equal = F.when(fresh, 0).otherwise(s["equal"]) + F.when(same, 1).otherwise(0)
        begin = F.when(fresh, s["i"]).otherwise(s["begin"])
        better = score > s["best"]
        return F.struct(
            (s["i"] + 1).alias("i"), score.alias("score"), equal.alias("equal"), begin.alias("begin"), F.greatest(score, s["best"]).alias("best"),
            F.when(better, equal).otherwise(s["matched"]).alias("matched"), F.when(better, begin).otherwise(s["first"]).alias("first"), F.when(better, s["i"]).otherwise(s["last"]).alias("last"),
        )

    return F.aggregate(flags, start, step)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, text_key, item_id, matched_words, overlap_words, share, doc_word``: the best overlap of each document and item.

    ``docs`` has ``doc_id, text``, ``benchmark`` has ``item_id, text``; other columns are ignored. Every place of every whole
    document is tried with every mask. A hit fixes an alignment of document and item; along it, words are compared around the hit,
    substitutions allowed, and the best stretch counts if it has LEAST_WORDS equal words and a share of LEAST_SHARE. Of an item
    of fewer words that share of its words is enough; an item shorter than a mask counts where all its words stand in a row.
    ``doc_word`` is the stretch's first word in the document, from 0. Texts that are NULL or empty have no hit. Repeated documents and items give one row each; rows with a NULL doc_id are told apart by text.
    """
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).distinct().withColumn("item_key", F.xxhash64("words"))
    seeds, short = _item_seeds(items)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words"))
    hits, shift = _hits(rows, seeds, short), F.col("shift")
    skipped = F.greatest(-shift, F.lit(0))  # words of the item before the document begins
    begin = F.greatest(shift, F.lit(0))
    part = F.slice("words", begin + 1, F.size("item_words") - skipped)
    hits = hits.select("doc_id", "text_key", "item_id", begin.alias("begin"), skipped.alias("skipped"), part.alias("part"), "item_words")
    places = hits.groupBy("doc_id", "text_key", "item_id", "begin", "skipped").agg(F.first("part").alias("part"), F.first("item_words").alias("item_words"))
    flags = F.transform("part", lambda w, i: w.eqNullSafe(F.get(F.col("item_words"), F.col("skipped") + i)))
    found = places.select("doc_id", "text_key", "item_id", "begin", F.size("item_words").alias("size"), _extended(flags).alias("x"))
    length = F.col("x.last") - F.col("x.first") + 1
    found = found.select("doc_id", "text_key", "item_id", F.col("x.matched").alias("matched_words"), length.alias("overlap_words"), (F.col("begin") + F.col("x.first")).alias("doc_word"), "size")
    least = F.when(F.col("size") >= LEAST_WORDS, LEAST_WORDS).when(F.col("size") >= SPAN, F.ceil(LEAST_SHARE * F.col("size"))).otherwise(F.col("size"))
    found = found.filter((F.col("matched_words") >= least) & (F.col("matched_words") >= LEAST_SHARE * F.col("overlap_words")))
    best = F.max(F.struct("matched_words", (-F.col("overlap_words")).alias("less"), (-F.col("doc_word")).alias("early"))).alias("best")
    out = found.groupBy("doc_id", "text_key", "item_id").agg(best)
    matched, overlap = F.col("best.matched_words"), -F.col("best.less")
    return out.select("doc_id", "text_key", "item_id", matched.alias("matched_words"), overlap.alias("overlap_words"), (matched / overlap).alias("share"), (-F.col("best.early")).alias("doc_word"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a verified overlap, with all their columns."""
    gone = contaminated(docs, benchmark).select("text_key").distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("key", F.xxhash64("row.text"))
    return row.join(gone, F.col("key") == F.col("text_key"), "left_anti").select("row.*")
