"""One row per key, and the newest rows of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(order_by: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(c) for c in order_by]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row of each key that comes first in descending ``order_by``, NULLs last.

    Asking for rank 1 lets Spark cut every input partition down to one row per key
    before the shuffle, so a key that holds much of the table costs no more than others.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first(order_by))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def newest_rows(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The ``n`` newest rows; ``order_by`` should end in a unique column."""
    return df.orderBy(*newest_first(order_by)).limit(n)
