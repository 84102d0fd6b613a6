"""Staged JSON files: reading a feed's prefix and writing the dated layouts."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.folders import read_text
from millrace.specs import POSITION, SOURCE_FILE

# The staged folder and the two date layouts under <table>/.
STAGED = "staged"
LAYOUT_YMD_FOLDERS = "YYYY/MM/DD"
LAYOUT_DAY = "YYYY-MM-DD"


def stage_path(root: str, feed: str, table: str) -> str:
    return f"{root.rstrip('/')}/{STAGED}/{feed}/{table}/"


def read_stage(
    spark: SparkSession,
    root: str,
    feed: str,
    table: str,
    stream: bool = False,
    whole: bool = False,
    **rate: str | int,
) -> DataFrame:
    """Text lines of every file under a feed's table, at any depth, with their file.

    ``whole=True`` reads each file as one value, for arrays that span lines. ``rate``
    takes the file source's own options, such as ``maxFilesPerTrigger``.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.format("text").option("recursiveFileLookup", True).option("wholetext", whole)
    for key, value in rate.items():
        reader = reader.option(key, value)
    lines = reader.load(stage_path(root, feed, table))
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """Adds ``_line``, which grows with the line's place inside one part of one file.

    It only orders lines of the same file part, so it does not depend on how Spark
    spreads the parts over tasks. For batch frames, including micro-batches.
    """
    return lines.withColumn("_line", F.monotonically_increasing_id())


def record_position(item: str | Column = "item") -> Column:
    return F.struct(
        F.col("_block").alias("block"),
        F.col("_line").alias("line"),
        (F.col(item) if isinstance(item, str) else item).alias("item"),
    ).alias(POSITION)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files under ``path`` with size and time, named as ``_metadata.file_path`` names them; their content is not read.

    Spark scans no file without bytes, so those come from the listing alone, without a time.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    names = spark.createDataFrame([(as_in_metadata(f),) for f in found.inputFiles()], "file string")
    sizes = found.select(F.col("_metadata.file_path").alias("file"), "length", F.col("modificationTime").alias("modified"))
    return names.join(sizes, "file", "left").fillna(0, ["length"])


def as_in_metadata(file: str) -> str:
    """A file's name as ``_metadata.file_path`` has it: local ones with one slash."""
    return "file:/" + file.removeprefix("file:///") if file.startswith("file:///") else file


def batch_files(spark: SparkSession, checkpoint: str, batch_id: int) -> list[str]:
    """The files of a micro-batch of one file source, also those without a line, as its checkpoint lists them.

    ``offsets`` tells up to which listing each batch goes, ``sources/0`` holds the listings; every tenth
    repeats those before it in a file of its own.
    """

    def listed_to(batch: int) -> int:
        last = (read_text(spark, f"{checkpoint}/offsets/{batch}") or "").strip().split("\n")[-1]
        return json.loads(last)["logOffset"] if last.startswith("{") else -1

    found = []
    for n in range(listed_to(batch_id - 1) + 1, listed_to(batch_id) + 1):
        path = f"{checkpoint}/sources/0/{n}"
        text = read_text(spark, path) or read_text(spark, f"{path}.compact") or ""
        entries = [json.loads(line) for line in text.split("\n") if line.startswith("{")]
        found += [as_in_metadata(e["path"]) for e in entries if e["batchId"] == n]
    return sorted(set(found))


def write_stage(
    df: DataFrame,
    root: str,
    feed: str,
    table: str,
    date_col: str,
    layout: str = LAYOUT_YMD_FOLDERS,
    max_records: int | None = None,
    mode: str = "append",
) -> str:
    """Writes records as JSON lines under the feed's table, in folders by date.

    ``max_records`` bounds the records of one file. Timestamps keep microseconds, with or without a zone.
    The frame's columns are the record, whatever their names; ``date_col`` only picks the folder.
    """
    day = F.col(date_col).cast("date")
    if layout == LAYOUT_YMD_FOLDERS:
        parts = {"y": F.date_format(day, "yyyy"), "m": F.date_format(day, "MM"), "d": F.date_format(day, "dd")}
    elif layout == LAYOUT_DAY:
        parts = {"dt": F.date_format(day, "yyyy-MM-dd")}
    else:
        raise ValueError(f"unknown date layout {layout!r}")
    options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}
    clash = {c.lower() for c in df.columns} & set(parts)
    # a record may have a field named like a folder: then it becomes text before the folders are named
    out = df.select(F.to_json(F.struct("*"), options).alias("value"), *[c.alias(n) for n, c in parts.items()]) if clash else df.withColumns(parts)
    # Rebalancing on the folder columns keeps a quiet day to one file and splits a busy one.
    out = out.hint("rebalance", *[F.col(p) for p in parts])
    writer = out.write.mode(mode).partitionBy(*parts)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    path = stage_path(root, feed, table)
    if clash:
        writer.text(path)
    else:
        writer.options(**options).json(path)
    return path
