"""The merge procedure: one call per table and batch, answered with a status text."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.specs import BATCH_ID, LOAD_ID, SPECS, TableSpec
from millrace.storage import Store
from millrace.streaming.loader import LoadOptions, merge_load

# The two answers of the procedure.
MERGED = "OK: merged batch {batch} for table {table}"
UNKNOWN_TABLE = "ERROR: unknown table {table}"


def merge_cdc_batch(
    store: Store,
    table: str,
    batch_id: str | None = None,
    options: LoadOptions = LoadOptions(),
    specs: dict[str, TableSpec] = SPECS,
) -> str:
    """Merges raw rows of ``table`` into its typed table and says so.

    Without ``batch_id`` all raw rows are replayed, with one only that batch's. Running
    it again leaves the same typed rows. Values that do not cast and strings that are too long
    are treated as ``options`` say, as in a load. One writer per table at a time.
    """
    spec = specs.get(table)
    if spec is None:
        return UNKNOWN_TABLE.format(table=table)
    raw = store.raw(spec)
    if batch_id is not None:
        raw = raw.filter(F.col(BATCH_ID) == batch_id)
    load_id = store.load_id(spec, "hand", uuid.uuid4().hex)
    merge_load(store, spec, raw.drop(LOAD_ID), load_id, options, options.started())
    return MERGED.format(batch="all" if batch_id is None else batch_id, table=table)
