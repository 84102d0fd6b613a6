"""Incremental pulls: rows past a high-water mark, and the mark itself."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.typed import cast_field
from millrace.sources.marks import packed_mark, unpacked_mark
from millrace.specs import RECORD, Field
from millrace.storage import if_exists


def read_table(spark: SparkSession, fmt: str, path: str | None = None, **options: Any) -> DataFrame:
    """Any batch source Spark can read, such as ``jdbc`` with ``url``, ``dbtable`` and partition bounds."""
    return spark.read.format(fmt).options(**options).load(path)


def mark_literal(mark: Any) -> Column:
    """A mark as a literal; a time without a zone stays a wall clock, whatever the session's zone."""
    if isinstance(mark, datetime) and mark.tzinfo is None:
        return F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(mark)


def incremental_pull(
    src: DataFrame,
    cursor_col: str | Column,
    hwm: Any = None,
    overlap: timedelta | int | None = None,
    keep_null: bool = False,
) -> DataFrame:
    """Rows of ``src`` past ``hwm``; all rows when there is none yet.

    The comparison is a plain filter, so Parquet and JDBC sources evaluate it
    themselves. ``overlap`` steps the mark back to catch rows committed late with an
    older cursor; the merge absorbs the repeats. ``keep_null`` takes rows without a cursor too,
    each time, since no mark tells which of them are new.
    """
    if hwm is None:
        return src
    cursor = F.col(cursor_col) if isinstance(cursor_col, str) else cursor_col
    floor = hwm - overlap if overlap is not None else hwm
    past = cursor > mark_literal(floor)
    return src.filter(past | cursor.isNull() if keep_null else past)


def object_pull(objects: DataFrame, age_field: Field, hwm: Any = None, overlap: timedelta | None = None) -> DataFrame:
    """Records of an object extract whose age field is past ``hwm``; records without one are kept."""
    if hwm is None:
        return objects
    floor = hwm - overlap if overlap is not None else hwm
    age = cast_field(F.col(RECORD), age_field)
    return objects.filter(age.isNull() | (age > mark_literal(floor)))


def next_hwm(df: DataFrame, cursor_col: str | Column) -> Any:
    """The largest cursor value pulled, or None when nothing was.

    A zoned cursor gives its wall clock in the session's zone, which is also how
    ``incremental_pull`` compares it.
    """
    return df.agg(top_of(df, cursor_col).alias("hwm")).first()["hwm"]


def top_of(df: DataFrame, cursor_col: str | Column) -> Column:
    """The aggregate behind ``next_hwm``."""
    cursor = F.col(cursor_col) if isinstance(cursor_col, str) else cursor_col
    zoned = df.select(cursor.alias("hwm")).schema["hwm"].dataType == T.TimestampType()
    return F.max(cursor.cast("timestamp_ntz") if zoned else cursor)


STATE_SCHEMA = T.StructType(
    [
        T.StructField("feed", T.StringType()),
        T.StructField("generation", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("mark", T.StringType()),
        T.StructField("batch_id", T.StringType()),
    ]
)


class PullState:
    """The high-water mark of each feed, of whatever type, one row, kept in two files written in turn.

    A crash while one is written leaves the other, which then only makes the last
    pull repeat. ``reset`` forgets the mark, so the next pull reads everything again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = f"{root.rstrip('/')}/state"

    def _slot(self, feed: str, seq: int) -> str:
        return f"{self.root}/{feed}/slot={seq % 2}"

    def get(self, feed: str) -> dict[str, Any]:
        rows = []
        for seq in (0, 1):
            slot = if_exists(self.spark, self._slot(feed, seq), STATE_SCHEMA)
            rows += slot.collect() if slot is not None else []
        if not rows:
            return {"feed": feed, "generation": 0, "seq": 0, "hwm": None, "batch_id": None}
        now = max(rows, key=lambda r: r["seq"]).asDict()
        return now | {"hwm": unpacked_mark(json.loads(now.pop("mark")))}

    def _put(self, feed: str, generation: int, seq: int, hwm: Any, batch_id: str | None) -> None:
        row = self.spark.createDataFrame([(feed, generation, seq, json.dumps(packed_mark(hwm)), batch_id)], STATE_SCHEMA)
        row.coalesce(1).write.mode("overwrite").parquet(self._slot(feed, seq))

    def advance(self, feed: str, hwm: Any, batch_id: str | None) -> None:
        """Keeps the later of the old and the new mark."""
        now = self.get(feed)
        marks = [m for m in (now["hwm"], hwm) if m is not None]
        self._put(feed, now["generation"], now["seq"] + 1, max(marks, default=None), batch_id)

    def reset(self, feed: str) -> None:
        now = self.get(feed)
        self._put(feed, now["generation"] + 1, now["seq"] + 1, None, None)
