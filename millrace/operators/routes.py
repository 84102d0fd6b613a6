"""Routing and binning of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUTE = "_route"
UNMATCHED = "unmatched"


def with_route(df: DataFrame, attribute: str, routes: Sequence[str]) -> DataFrame:
    """Adds the route of each row: the attribute's value when it is a known route."""
    value = F.col(attribute)
    return df.withColumn(ROUTE, F.when(value.isin(list(routes)), value).otherwise(UNMATCHED))


def split_routes(df: DataFrame, attribute: str, routes: Sequence[str]) -> dict[str, DataFrame]:
    """One frame per route, unmatched rows included; no row is in two or none."""
    routed = with_route(df, attribute, routes)
    return {r: routed.filter(F.col(ROUTE) == r).drop(ROUTE) for r in (*routes, UNMATCHED)}


def write_routes(df: DataFrame, attribute: str, routes: Sequence[str], path: str) -> None:
    """All routes in one pass, one folder each."""
    with_route(df, attribute, routes).write.mode("append").partitionBy(ROUTE).parquet(path)


def bin_counts(df: DataFrame, ts_col: str, max_age: str) -> DataFrame:
    """Records per bin, a bin holding the records of one ``max_age`` span."""
    return (
        df.groupBy(F.window(ts_col, max_age).alias("bin"))
        .agg(F.count("*").alias("n_records"))
        .select(F.col("bin.start").alias("bin_start"), "n_records")
    )
