"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.folders import remove_folder
from millrace.session import scratch_dir


#: No marker files beside intermediate tables: nobody looks for them, and on a local file system each costs the driver two process launches.
UNMARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def stored(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    writer = df.write.options(**UNMARKED)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one run that go as soon as they are told to; what reads them must be stored by then."""

    def __init__(self):
        self.paths: dict[int, str] = {}

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_dir(df.sparkSession, label)
        df.write.parquet(path)
        out = df.sparkSession.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            remove_folder(table.sparkSession, self.paths.pop(id(table)))


def shuffle_width(spark) -> int:
    """How many shuffle partitions the session asks for; the user sizes it to the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
