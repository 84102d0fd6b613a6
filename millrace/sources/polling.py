"""A table polled as a stream: the offsets are the marks of its cursor, of whatever type that has.

Spark keeps the marks in the query's checkpoint, repeats an unfinished poll between the same two marks, and starts over
with a new checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from millrace.shipping import send_package
from millrace.sources.marks import packed_mark, unpacked_mark

FORMAT = "millrace_poll"

@dataclass
class Piece(InputPartition):
    """A row group of a file, and between which marks its rows are wanted."""

    file: str
    group: int
    after: dict
    upto: dict


class PollReader(DataSourceStreamReader):
    """Row groups of Parquet files, chosen by the cursor's statistics; rows past one mark and up to the next."""

    def __init__(self, path: str, cursor: str, columns: list[str]):
        self.path, self.cursor, self.columns = path, cursor, columns

    def _dataset(self, file: str | None = None) -> ds.Dataset:
        if "://" in self.path:
            system, path = pyarrow.fs.FileSystem.from_uri(self.path)
        else:
            system, path = pyarrow.fs.LocalFileSystem(), self.path.removeprefix("file:")
        return ds.dataset(file or path, format="parquet", filesystem=system)

    def _groups(self) -> Iterator[tuple[str, int, Any, Any, bool]]:
        """File, number, least and largest cursor of each row group, and whether some row has none."""
        for fragment in self._dataset().get_fragments():
            for group in fragment.split_by_row_group():
                info = group.row_groups[0]
                span = (info.statistics or {}).get(self.cursor)
                if span is None or span["min"] is None:
                    found = group.to_table(columns=[self.cursor]).column(0)
                    found = found if not found.type.equals(pa.timestamp("ns")) else found.cast(pa.timestamp("us"), safe=False)
                    limits = pc.min_max(found).as_py()
                    yield fragment.path, info.id, limits["min"], limits["max"], found.null_count > 0
                else:
                    yield fragment.path, info.id, span["min"], span["max"], True

    def initialOffset(self) -> dict:
        return packed_mark(None)

    def latestOffset(self) -> dict:
        tops = [top for _, _, _, top, _ in self._groups() if top is not None]
        return packed_mark(max(tops, default=None))

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        after, upto = unpacked_mark(start), unpacked_mark(end)
        found = []
        for file, group, low, top, gaps in self._groups():
            new = low is not None and upto is not None and low <= upto and (after is None or top > after)
            # rows without a cursor are no one's news; they come with the first poll
            if new or (after is None and gaps):
                found.append(Piece(file, group, start, end))
        return found

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        after, upto = unpacked_mark(partition.after), unpacked_mark(partition.upto)
        cursor = ds.field(self.cursor)
        wanted = cursor <= upto if after is None else (cursor > after) & (cursor <= upto)
        if after is None:
            wanted = wanted | cursor.is_null()
        (fragment,) = self._dataset(partition.file).get_fragments()
        (group,) = [g for g in fragment.split_by_row_group() if g.row_groups[0].id == partition.group]
        for batch in group.to_batches(columns=self.columns, filter=wanted):
            if batch.num_rows:
                yield batch

    def commit(self, end: dict) -> None:
        pass


class PollSource(DataSource):
    """Options: ``path`` of Parquet data that grows, and its ``cursor`` column."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: T.StructType) -> PollReader:
        return PollReader(self.options["path"], self.options["cursor"], schema.names)


def read_polled(spark: SparkSession, path: str, cursor: str) -> DataFrame:
    """A stream of the rows of a Parquet table that grows, each trigger those past the last mark of ``cursor``.

    A row that appears later with a cursor at or before the mark is not seen, as with any poll by a mark. Rows without
    a cursor come with the first poll only.
    """
    send_package(spark)
    spark.dataSource.register(PollSource)
    schema = spark.read.parquet(path).schema
    return spark.readStream.format(FORMAT).schema(schema).option("path", path).option("cursor", cursor).load()
