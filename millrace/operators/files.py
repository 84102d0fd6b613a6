"""File-level bookkeeping: load history, files not yet loaded, files past their keep time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.merge import now_ntz
from millrace.specs import SOURCE_FILE

# Outcomes of a file load and the kind of statement.
LOADED = "Loaded"
PARTIAL = "Partially loaded"
FAILED = "Load failed"
COPY = "COPY"
MERGE = "MERGE"

# Characters kept of an error's text.
MESSAGE_LENGTH = 2000

# Days staged files and error files are kept.
STAGED_DAYS = 3
ERROR_DAYS = 30

# Rows of the failed-load report.
ERROR_REPORT_ROWS = 20


def audit_rows(
    landed: DataFrame,
    table_name: str,
    environment: str,
    start: datetime | str,
    end: datetime | str | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """One row per file of a load: rows parsed, loaded and refused, and the outcome.

    ``landed`` only needs ``_source_file`` and ``reason``, NULL for a good record. Rows are
    counted per file inside each task before any shuffle. A file of ``files`` without any
    record has a row with zeros.
    """
    counts = landed.groupBy(F.col(SOURCE_FILE).alias("file")).agg(
        F.count_if(F.col("reason").isNull()).alias("row_count"),
        F.count("reason").alias("error_count"),
        F.min("reason").alias("error_message"),
    )
    if files is not None:
        counts = files.select("file").distinct().join(counts, "file", "full_outer").fillna(0, ["row_count", "error_count"])
    return counts.select(
        F.lit(table_name).alias("table_name"),
        F.lit(environment).alias("environment"),
        F.lit(COPY).alias("query_type"),
        "file",
        load_status(F.col("row_count"), F.col("error_count")).alias("status"),
        (F.col("row_count") + F.col("error_count")).alias("row_parsed"),
        "row_count",
        "error_count",
        "error_message",
        now_ntz(start).alias("start_time"),
        now_ntz(end).alias("last_load_time"),
    )


def failure_rows(
    spark: SparkSession,
    table_name: str,
    environment: str,
    query_type: str,
    files: Sequence[str | None],
    message: str,
    start: datetime | str,
) -> DataFrame:
    """One row per file of a try that failed. Nothing is known of its records, so ``row_parsed`` is NULL."""
    rows = spark.createDataFrame([(f,) for f in files], "file string")
    unknown = F.lit(None).cast("long")
    return rows.select(
        F.lit(table_name).alias("table_name"),
        F.lit(environment).alias("environment"),
        F.lit(query_type).alias("query_type"),
        "file",
        F.lit(FAILED).alias("status"),
        unknown.alias("row_parsed"),
        F.lit(0).cast("long").alias("row_count"),
        unknown.alias("error_count"),
        F.lit(message[:MESSAGE_LENGTH]).alias("error_message"),
        now_ntz(start).alias("start_time"),
        now_ntz().alias("last_load_time"),
    )


def recorded(audit: DataFrame) -> DataFrame:
    """Files of loads that landed; a try that failed does not count."""
    return (audit.filter(F.col("row_parsed").isNotNull()) if "row_parsed" in audit.columns else audit).select("file")


def load_status(row_count: Column, error_count: Column) -> Column:
    return F.when(error_count == 0, LOADED).when(row_count > 0, PARTIAL).otherwise(FAILED)


# How a staged file's path tells its day, in the two layouts as written by a
# dataflow and as written by Spark.
DAY_IN_PATH = (
    r"/(\d{4})/(\d{2})/(\d{2})/[^/]*$",
    r"/(\d{4})-(\d{2})-(\d{2})/[^/]*$",
    r"/y=(\d{4})/m=(\d{2})/d=(\d{2})/",
    r"/dt=(\d{4})-(\d{2})-(\d{2})/",
)


def file_day(file: Column) -> Column:
    """The day a staged file's folder names, NULL when it names none."""
    days = []
    for pattern in DAY_IN_PATH:
        parts = [F.regexp_extract(file, pattern, i) for i in (1, 2, 3)]
        days.append(F.concat_ws("-", *parts).try_cast("date"))
    return F.coalesce(*days)


def new_files(files: DataFrame, audit: DataFrame) -> DataFrame:
    """Files no load has recorded yet."""
    return files.join(recorded(audit), "file", "left_anti")


def with_line_counts(files: DataFrame, lines: DataFrame) -> DataFrame:
    """Files with the number of their ``lines``, counted per file inside each task before any shuffle; none for an empty file."""
    counts = lines.groupBy(F.col(SOURCE_FILE).alias("file")).agg(F.count("*").alias("n_rows"))
    return files.join(counts, "file", "left").fillna(0, ["n_rows"])


def expired_files(files: DataFrame, audit: DataFrame, now: datetime | str, days: int = STAGED_DAYS) -> DataFrame:
    """Files older than ``days`` by their ``dt`` that a load has recorded.

    A file still waiting to be loaded is kept whatever its age.
    """
    last_kept = F.date_sub(F.lit(str(now)).cast("timestamp_ntz").cast("date"), days)
    return files.filter(F.col("dt") < last_kept).join(recorded(audit), "file", "left_semi")


def load_history(audit: DataFrame, table_name: str, start: datetime | str, only_problems: bool = False) -> DataFrame:
    """Loads of one table since ``start``, newest first."""
    rows = audit.filter(
        (F.col("table_name") == table_name) & (F.col("last_load_time") >= F.lit(str(start)).cast("timestamp_ntz"))
    )
    if only_problems:
        rows = rows.filter(F.col("status") != LOADED)
    return rows.orderBy(F.desc("last_load_time"), "file")


def load_errors(audit: DataFrame, environment: str, n: int = ERROR_REPORT_ROWS) -> DataFrame:
    """The newest failed loads of an environment."""
    failed = audit.filter(
        (F.col("query_type") == COPY) & F.col("error_message").isNotNull() & (F.col("environment") == environment)
    )
    return failed.orderBy(F.desc("start_time"), "file").limit(n)
