"""Records gathered into bins that close when they are full or old, and written a file per bin."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.shipping import send_package

FULL, OLD = "full", "old"
LANE = "lane"

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Bins(StatefulProcessor):
    """One open bin per key. It closes with its ``max_records``-th record, or by a timer ``max_age_ms`` after its first.

    Between micro-batches the state holds fewer than ``max_records`` records of a key, whatever the key's share of all.
    """

    def __init__(self, columns: list[str], max_records: int, max_age_ms: int):
        self.columns, self.max_records, self.max_age_ms = columns, max_records, max_age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "value string")
        self.head = handle.getValueState("head", "opened long, number long")

    def _state(self) -> tuple[int, int, list[str]]:
        if not self.head.exists():
            return 0, 0, []
        opened, number = self.head.get()
        return opened, number, [r[0] for r in self.waiting.get()] if self.waiting.exists() else []

    def _keep(self, opened: int, number: int, records: list[str]) -> None:
        self.head.update((opened, number))
        if records:
            self.waiting.put([(r,) for r in records])
        else:
            self.waiting.clear()

    def _frame(self, closed: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(closed, columns=self.columns)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        opened, number, records = self._state()
        fresh = not records
        for part in rows:
            # records are taken in runs, each as many as the open bin has room for
            values, at, closed = part["value"].tolist(), 0, []
            while at < len(values):
                if not records:
                    opened, fresh = now, True
                taken = values[at : at + self.max_records - len(records)]
                records, at = records + taken, at + len(taken)
                if len(records) == self.max_records:
                    closed.append((*key, number, opened, now, FULL, len(records), records))
                    number, records = number + 1, []
            if closed:
                yield self._frame(closed)
        if records and fresh:
            self.handle.registerTimer(opened + self.max_age_ms)
        self._keep(opened, number, records)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        opened, number, records = self._state()
        # the timer of a bin that was full before its time finds the next one, or none
        if records and opened + self.max_age_ms <= expiredTimerInfo.getExpiryTimeInMs():
            yield self._frame([(*key, number, opened, timerValues.getCurrentProcessingTimeInMs(), OLD, len(records), records)])
            self._keep(opened, number + 1, [])

    def close(self) -> None:
        pass


def closed_bins(
    records: DataFrame, attributes: Sequence[str], max_records: int, max_age_s: float, lanes: int = 1, value: str = "value"
) -> DataFrame:
    """A stream of closed bins over a stream of records: a bin holds records with the same ``attributes``.

    Columns: the attributes, ``lane``, ``number`` within them, ``opened`` and ``closed`` (epoch milliseconds), ``reason``,
    ``n_records`` and ``records``. A frequent combination of attributes is spread over ``lanes`` bins that fill side by side.
    """
    send_package(records.sparkSession)
    keyed = records.select(*attributes, F.pmod(F.xxhash64(value), F.lit(lanes)).cast("int").alias(LANE), F.col(value).alias("value"))
    out = T.StructType([*(keyed.schema[a] for a in attributes), T.StructField(LANE, T.IntegerType())])
    for name, kind in (("number", "long"), ("opened", "long"), ("closed", "long"), ("reason", "string"), ("n_records", "int"), ("records", "array<string>")):
        out = out.add(name, T.DataType.fromDDL(kind))
    bins = Bins(out.names, max_records, int(max_age_s * 1000))
    return keyed.groupBy(*attributes, LANE).transformWithStateInPandas(bins, out, "Append", "ProcessingTime")


def start_binning(
    spark: SparkSession,
    records: DataFrame,
    path: str,
    checkpoint: str,
    attributes: Sequence[str],
    max_records: int,
    max_age_s: float,
    lanes: int = 1,
    value: str = "value",
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Writes each closed bin as one text file under ``path/files`` and a row of it under ``path/bins``.

    A micro-batch owns the folders ``batch=<id>`` and overwrites them when it is repeated. The bins are stored before the
    files are made of them, so a repeat of the second step does not touch the state.
    """
    bins = closed_bins(records, attributes, max_records, max_age_s, lanes, value)

    def body(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/bins/batch={batch_id}")
        stored = batch.sparkSession.read.schema(batch.schema).parquet(f"{path}/bins/batch={batch_id}")
        name = F.concat_ws("-", LANE, "number").alias("bin")
        lines = stored.select(*attributes, name, F.explode("records").alias("value"))
        lines = lines.repartition(*attributes, "bin").sortWithinPartitions(*attributes, "bin")
        lines.write.mode("overwrite").partitionBy(*attributes, "bin").text(f"{path}/files/batch={batch_id}")

    before = spark.conf.get(_STATE_STORE)
    spark.conf.set(_STATE_STORE, _ROCKS)
    try:
        writer = bins.writeStream.foreachBatch(body).outputMode("append").option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()
    finally:
        spark.conf.set(_STATE_STORE, before)


def stop_between_batches(query: StreamingQuery, patience_s: float = 30) -> None:
    """Stops a query once the micro-batch that runs now is done, or after some time in any case.

    A query with timers runs one empty micro-batch after the other; the next one is not waited for, it is repeated by a restart.
    """
    until, before = time.time() + patience_s, _last_batch(query)
    while query.isActive and query.status["isTriggerActive"] and _last_batch(query) == before and time.time() < until:
        time.sleep(0.05)
    query.stop()


def _last_batch(query: StreamingQuery) -> int | None:
    progress = query.lastProgress
    return progress["batchId"] if progress else None
