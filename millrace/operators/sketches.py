"""Small mergeable summaries of loads: how long changes took to arrive, and which keys have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.specs import LOADED_AT, RAW_CURSOR, RAW_KEY

LATENCY, ARRIVALS = "latency", "arrivals"

# Size of a quantile sketch: at 800 a rank is off by less than a hundredth.
SKETCH_K = 800

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("sum_seconds", T.LongType()),
        T.StructField("max_seconds", T.LongType()),
        T.StructField("summary", T.BinaryType()),
    ]
)


def _seconds(moment: Column) -> Column:
    return F.unix_seconds(moment.cast("timestamp"))


def _no(kind: str) -> Column:
    return F.lit(None).cast(kind)


def summaries(raw: DataFrame) -> DataFrame:
    """Summaries of raw rows by the day they were loaded: one of their delays, and for whole-number keys one per block of keys.

    Delays are whole seconds from the cursor to the load, as a quantile sketch beside their exact number, sum and largest.
    Keys are exact bitmaps of 32768 numbers each. Rows without a cursor or key are left out of the one or the other.
    """
    day = F.col(LOADED_AT).cast("date").alias("day")
    delays = raw.select(day, (_seconds(F.col(LOADED_AT)) - _seconds(F.col(RAW_CURSOR))).alias("s")).filter("s IS NOT NULL")
    out = delays.groupBy("day").agg(
        F.count("*").alias("n_rows"),
        F.sum("s").alias("sum_seconds"),
        F.max("s").alias("max_seconds"),
        F.kll_sketch_agg_bigint("s", F.lit(SKETCH_K)).alias("summary"),
    )
    out = out.select(F.lit(LATENCY).alias("kind"), "day", _no("long").alias("bucket"), "n_rows", "sum_seconds", "max_seconds", "summary")
    if raw.schema[RAW_KEY].dataType != T.LongType():
        return out
    keys = raw.select(day, F.col(RAW_KEY).alias("key")).filter("key IS NOT NULL")
    keys = keys.select("day", F.bitmap_bucket_number("key").alias("bucket"), F.bitmap_bit_position("key").alias("bit"))
    bits = keys.groupBy("day", "bucket").agg(F.count("*").alias("n_rows"), F.bitmap_construct_agg("bit").alias("summary"))
    return out.unionByName(
        bits.select(F.lit(ARRIVALS).alias("kind"), "day", "bucket", "n_rows", _no("long").alias("sum_seconds"), _no("long").alias("max_seconds"), "summary")
    )


def merged_summaries(found: DataFrame) -> DataFrame:
    """Summaries of many loads as one per day, kind and block of keys."""
    totals = [F.sum("n_rows").alias("n_rows"), F.sum("sum_seconds").alias("sum_seconds"), F.max("max_seconds").alias("max_seconds")]
    delays = found.filter(F.col("kind") == LATENCY).groupBy("kind", "day", "bucket").agg(*totals, F.kll_merge_agg_bigint("summary").alias("summary"))
    keys = found.filter(F.col("kind") == ARRIVALS).groupBy("kind", "day", "bucket").agg(*totals, F.bitmap_or_agg("summary").alias("summary"))
    return delays.unionByName(keys).select(*SUMMARY_SCHEMA.names)


def merged_latency(found: DataFrame, share: float = 0.95) -> DataFrame:
    """Number, mean and largest delay of all summarised rows, exact, and a quantile from the merged sketches."""
    total = found.filter(F.col("kind") == LATENCY).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        (F.sum("sum_seconds") / F.sum("n_rows")).alias("avg_seconds"),
        F.max("max_seconds").alias("max_seconds"),
        F.kll_merge_agg_bigint("summary").alias("sketch"),
    )
    at = F.when(F.col("n_rows") > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(share)))
    return total.withColumn("quantile_seconds", at).drop("sketch")


def seen_keys(found: DataFrame) -> DataFrame:
    """``bucket, bits``: the keys of all summarised rows."""
    return found.filter(F.col("kind") == ARRIVALS).groupBy("bucket").agg(F.bitmap_or_agg("summary").alias("bits"))


def _as_bits(keys: DataFrame, key: str) -> DataFrame:
    numbered = keys.select(F.col(key).cast("long").alias("key")).filter("key IS NOT NULL")
    numbered = numbered.select(F.bitmap_bucket_number("key").alias("bucket"), F.bitmap_bit_position("key").alias("bit"))
    return numbered.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def arrived_by_bitmap(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """How many distinct expected keys have a summarised row; blocks of keys are compared as a whole."""
    both = _as_bits(expected, key).unionByName(seen_keys(found)).groupBy("bucket").agg(F.count("*").alias("n"), F.bitmap_and_agg("bits").alias("bits"))
    return both.agg(F.coalesce(F.sum(F.when(F.col("n") == 2, F.bitmap_count("bits"))), F.lit(0)).alias("n_arrived"))


def missing_by_bitmap(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Expected keys without a summarised row."""
    keys = expected.select(F.col(key)).filter(F.col(key).isNotNull()).distinct()
    number = F.col(key).cast("long")
    keys = keys.withColumns({"bucket": F.bitmap_bucket_number(number), "_bit": F.bitmap_bit_position(number)})
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_seen = F.call_function("shiftright", byte, (F.col("_bit") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return keys.join(seen_keys(found), "bucket", "left").filter(~F.coalesce(is_seen, F.lit(False))).select(key)
