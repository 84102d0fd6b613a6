"""Raw rows: one VARIANT per record plus lineage columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.merge import now_ntz
from millrace.specs import (
    BATCH_ID,
    LINEAGE_OP,
    LINEAGE_TS,
    LOADED_AT,
    OP_DELETE,
    OP_INSERT,
    OP_POLLED,
    OP_UPDATE,
    POSITION,
    RECORD,
    SOURCE_FILE,
    TableSpec,
)

UNKNOWN_OPERATION = "unknown operation"


def epoch_millis_batch_id(load_ts: datetime | str | Column | None = None) -> Column:
    """Batch id of a pull: its start as epoch milliseconds."""
    return F.unix_millis(now_ntz(load_ts).cast("timestamp")).cast("string")


def to_raw(
    good: DataFrame,
    spec: TableSpec,
    op: str | Column = OP_POLLED,
    load_ts: datetime | str | Column | None = None,
    batch_id: str | Column | None = None,
    cdc_ts: Column | None = None,
    position: Column | None = None,
    record_col: str = "record",
    also: Sequence[str] = (),
) -> DataFrame:
    """Raw rows of parsed records, with the columns ``also`` as they are.

    Needs ``record`` and ``_source_file``. The batch id is the file's path unless
    given. A polled feed writes a constant operation and the load time; a change log
    passes the record's own.
    """
    loaded = now_ntz(load_ts)
    if batch_id is None:
        batch_id = F.col(SOURCE_FILE)
    elif isinstance(batch_id, str):
        batch_id = F.lit(batch_id)
    columns = [F.col(record_col).alias(RECORD)]
    if spec.change_columns:
        columns.append((F.lit(op) if isinstance(op, str) else op).alias(LINEAGE_OP))
        columns.append((loaded if cdc_ts is None else cdc_ts).alias(LINEAGE_TS))
    columns += [
        loaded.alias(LOADED_AT),
        F.col(SOURCE_FILE),
        batch_id.alias(BATCH_ID),
        (F.col(POSITION) if position is None else position).alias(POSITION),
        *also,
    ]
    return good.select(*columns)


def operation_of(record: Column, path: str = "$.op") -> Column:
    """Operation of a change event, NULL when it is none of the three kinds."""
    op = F.upper(F.try_variant_get(record, path, "string"))
    return F.when(op.isin(OP_INSERT, OP_UPDATE, OP_DELETE), op)


def change_time_of(record: Column, path: str = "$.ts") -> Column:
    return F.try_variant_get(record, path, "timestamp_ntz")
