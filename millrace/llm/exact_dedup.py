"""Exact duplicates by a tree merge of sorted digest runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm._scratch import shuffle_width, stored

#: How many runs meet in one merge; a binomial exchange of radix 2**FAN_BITS.
FAN_BITS = 4
_KEY = ["digest", "norm_chars", "check"]


def normalised(text: Column) -> Column:
    """The text without the characters ``[\\x20\\x09-\\x0D]``; NULL counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for char in (" ", "\n", "\r", "\t", "\x0b", "\x0c"):
        out = F.replace(out, F.lit(char), F.lit(""))
    return out


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, chars, digest, norm_chars, check`` for every row of ``docs(doc_id, text)``."""
    norm = docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"), normalised(F.col("text")).alias("norm"))
    return norm.select("doc_id", "chars", F.sha2("norm", 256).alias("digest"), F.length("norm").alias("norm_chars"), F.xxhash64("norm").alias("check"))


def _keeper() -> Column:
    """The row that stays among rows of a text: most characters, then smallest identifier (NULL identifiers last)."""
    return F.min("best").alias("best")


def merge_runs(marked: DataFrame, width: int | None = None) -> DataFrame:
    """One row per distinct text: its key, ``best`` (the row that stays) and ``n`` (its number of rows).

    Every partition first folds its rows to a run: one entry per digest. Runs then meet in binomial rounds.
    In round j, the runs whose slot numbers differ in digit j only swap entries, each taking those whose
    digest owner has its digit; a merge of the 2**FAN_BITS runs it then holds leaves one entry per digest, of which
    the verified one (same digest, same length, same second hash) with the smallest rank is retained. After
    log(width) rounds each slot owns a range of digests. An entry of a hot digest is sent once per run, so a
    third of all rows being copies makes no large task, and no slot ever sees more than its share of entries.
    """
    spark = marked.sparkSession
    slots = width or shuffle_width(spark)
    digits = max(1, -(-(slots - 1).bit_length() // FAN_BITS))
    whole = 1 << (digits * FAN_BITS)
    best = F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("nameless"), "doc_id")
    # owner of a digest: its leading bits; the first slot: the partition the row lies in
    owner = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") % whole
    runs = marked.select(*_KEY, best.alias("best"), owner.alias("owner"), (F.spark_partition_id() % whole).cast("long").alias("slot"), F.lit(1).cast("long").alias("n"))
    for digit in range(digits):
        low = digit * FAN_BITS
        mask = ((1 << FAN_BITS) - 1) << low
        next_slot = F.col("slot").bitwiseAND(F.lit(~mask)).bitwiseOR(F.col("owner").bitwiseAND(F.lit(mask)))
        runs = runs.withColumn("slot", next_slot).groupBy("slot", "owner", *_KEY).agg(_keeper(), F.sum("n").alias("n"))
    return runs.select(*_KEY, "best", "n")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Which row of each group of equal texts stays.

    Takes ``doc_id, text`` of ``docs`` (other columns are ignored) and returns one row per row of ``docs``:
    ``doc_id, keep_id, group_size, kept, text_sha256``. Texts are equal when identical without the
    characters ``[\\x20\\x09-\\x0D]``; NULL is empty, and empty texts are copies of each other. The row with the
    most characters in the original text stays, then the smallest doc_id; a NULL doc_id comes last. Of repeated
    rows with one doc_id and equal texts, every one that has the most characters counts as kept: nothing tells them
    apart (``keep_one`` leaves one of them). An empty table gives an empty result.
    """
    marked = stored(digests(docs), "digests")
    keep = merge_runs(marked).select(*_KEY, "n", F.col("best.doc_id").alias("keep_id"), (-F.col("best.less")).alias("keep_chars"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    return marked.join(keep, _KEY).select("doc_id", "keep_id", F.col("n").alias("group_size"), kept.alias("kept"), F.col("digest").alias("text_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns and no others; of repeated rows one stays.

    Texts are shuffled once, by doc_id and digest: the join and the choice among repeats share that exchange.
    Repeats that differ in further columns are ordered by those. Columns may have any names.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    norm = normalised(F.col("row.text"))
    keyed = docs.select(row.alias("row")).select(
        "row",
        F.coalesce("row.doc_id", F.lit(0).cast("long")).alias("id0"),
        F.col("row.doc_id").isNull().alias("no_id"),
        F.sha2(norm, 256).alias("digest"),
        F.length(F.coalesce("row.text", F.lit(""))).cast("long").alias("chars"),
    )
    keep = merge_runs(stored(digests(docs), "digests")).select(
        F.coalesce("best.doc_id", F.lit(0).cast("long")).alias("id0"), F.col("best.doc_id").isNull().alias("no_id"), "digest", (-F.col("best.less")).alias("chars")
    )
    on = ["id0", "no_id", "digest", "chars"]
    met = keyed.join(keep.hint("merge"), on, "left_semi")
    return met.groupBy(*on).agg(F.min("row").alias("row")).select("row.*")
