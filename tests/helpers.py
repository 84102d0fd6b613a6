"""Small frames for tests."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from millrace.specs import CUSTOMERS, POSITION_TYPE

DAY = dt.datetime(2024, 1, 1)


def at(hours):
    return None if hours is None else DAY + dt.timedelta(hours=hours)


def raw_customers(spark, rows, spec=CUSTOMERS, loaded=0, batch="b"):
    """Raw rows of ``(record dict, operation, cdc hours, position)`` tuples."""
    data = [
        (json.dumps(r[0]), r[1] if len(r) > 1 else "UPSERT", at(r[2] if len(r) > 2 else 0), at(loaded), f"{batch}.json", batch, (0, r[3] if len(r) > 3 else i, 0))
        for i, r in enumerate(rows)
    ]
    schema = (
        "j string, _cdc_operation string, _cdc_timestamp timestamp_ntz, _loaded_at timestamp_ntz, _source_file string, "
        f"_batch_id string, _record_pos {POSITION_TYPE.simpleString()}"
    )
    df = spark.createDataFrame(data, schema)
    return df.select(F.parse_json("j").alias("_raw_json"), *[c for c in df.columns if c != "j"])


def customer(id_, status, hours, created=None, **extra):
    stamp = None if hours is None else at(hours).isoformat()
    return {"id": id_, "status": status, "updated_at": stamp, "created_at": at(created or 0).isoformat(), **extra}


def write_file(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    # Written aside first, as a stage writer does, so a listing never sees half a file.
    part = os.path.join(root, "." + os.path.basename(name))
    with open(part, "w") as f:
        f.write(text)
    os.rename(part, path)
    return path


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
