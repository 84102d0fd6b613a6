"""Monitoring: counts, freshness, operations, throughput and latency."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.specs import LINEAGE_OP, LOADED_AT

# Fixed value: a feed without new rows for this long is an incident.
STALE_HOURS = 2


def _at(moment: datetime | str) -> Column:
    return F.lit(str(moment)).cast("timestamp_ntz")


def hours_before(moment: datetime | str, hours: int) -> Column:
    return _at(moment) - F.expr(f"INTERVAL '{int(hours)}' HOUR")


def _report(tables: dict[str, DataFrame], *aggregates: Column) -> DataFrame:
    parts = [df.agg(*aggregates).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _report(tables, F.count("*").alias("n_rows"))


def freshness(tables: dict[str, DataFrame], loaded_at: str = LOADED_AT) -> DataFrame:
    """Rows and newest load time of each table."""
    return _report(tables, F.count("*").alias("n_rows"), F.max(loaded_at).alias("last_loaded_at"))


def freshness_by(df: DataFrame, feed_col: str, loaded_at: str = LOADED_AT) -> DataFrame:
    """Freshness of the feeds that share one table."""
    return df.groupBy(feed_col).agg(F.count("*").alias("n_rows"), F.max(loaded_at).alias("last_loaded_at"))


def stale_feeds(report: DataFrame, now: datetime | str, hours: int = STALE_HOURS) -> DataFrame:
    """A freshness report with a flag for feeds silent for more than ``hours``."""
    silent = F.col("last_loaded_at").isNull() | (F.col("last_loaded_at") < hours_before(now, hours))
    return report.withColumn("is_stale", silent)


def landed_since(df: DataFrame, now: datetime | str, hours: int = 1, loaded_at: str = LOADED_AT) -> DataFrame:
    """Rows that landed in the last hours, with the first and last load time."""
    recent = df.filter(F.col(loaded_at) > hours_before(now, hours))
    return recent.agg(
        F.count("*").alias("n_rows"), F.min(loaded_at).alias("first_loaded_at"), F.max(loaded_at).alias("last_loaded_at")
    )


def ops_by_type(
    df: DataFrame, now: datetime | str | None = None, hours: int = 1, loaded_at: str = "_etl_loaded_at"
) -> DataFrame:
    """Rows per operation, over all rows or those of the last hours before ``now``."""
    if now is not None:
        df = df.filter(F.col(loaded_at) > hours_before(now, hours))
    return df.groupBy(LINEAGE_OP).agg(F.count("*").alias("n_rows"))


def throughput(audit: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """Rows loaded in a time span and rows per second, per table."""
    seconds = F.unix_seconds(_at(end).cast("timestamp")) - F.unix_seconds(_at(start).cast("timestamp"))
    inside = audit.filter((F.col("last_load_time") > _at(start)) & (F.col("last_load_time") <= _at(end)))
    return (
        inside.groupBy("table_name")
        .agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n_rows"))
        .withColumn("rows_per_second", F.col("n_rows") / F.nullif(seconds, F.lit(0)))
    )


def growth(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two count reports side by side, and whether a table lost rows."""
    return (
        before.withColumnRenamed("n_rows", "n_before")
        .join(after.withColumnRenamed("n_rows", "n_after"), "table_name", "full_outer")
        .withColumn("has_dropped", F.coalesce("n_after", F.lit(0)) < F.coalesce("n_before", F.lit(0)))
    )


def latency(df: DataFrame, changed_at: str, feed_col: str | None = None, loaded_at: str = LOADED_AT) -> DataFrame:
    """Whole seconds from change to load: average, largest and 95th percentile.

    Rows are counted per distinct second first; the exact percentile then works on
    those few counts instead of on every row.
    """
    seconds = F.unix_seconds(F.col(loaded_at).cast("timestamp")) - F.unix_seconds(F.col(changed_at).cast("timestamp"))
    keys = [feed_col] if feed_col else []
    counted = df.select(*keys, seconds.alias("_s")).groupBy(*keys, "_s").agg(F.count("*").alias("_n"))
    return counted.groupBy(*keys).agg(
        F.sum("_n").alias("n_rows"),
        (F.sum(F.col("_s") * F.col("_n")) / F.sum("_n")).alias("avg_seconds"),
        F.max("_s").alias("max_seconds"),
        F.percentile("_s", 0.95, F.col("_n")).alias("p95_seconds"),
    )
