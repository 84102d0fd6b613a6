"""Typed columns out of raw records: path extraction, casts, and what to do with bad values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.specs import (
    BATCH_ID,
    LOADED_AT,
    POSITION,
    RECORD,
    SOURCE_FILE,
    Field,
    TableSpec,
)

BAD_FIELDS = "_bad_fields"


def _read(record: Column, f: Field, type_: str, strict: bool) -> Column:
    getter = F.variant_get if strict else F.try_variant_get
    return getter(record, f.path, type_)


def at_utc(instant: Column) -> Column:
    """Wall clock in UTC of a zoned timestamp, whatever the session's zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def cast_field(record: Column, f: Field, strict: bool = True, normalize_utc: bool = False) -> Column:
    """The field's value in its column type, before any length rule.

    A missing path and a JSON null give NULL. ``strict`` fails on a value that does
    not cast; otherwise that value gives NULL. Whole numbers round half away from
    zero, as decimals do.
    """
    if f.path is None:
        return F.lit(None).cast(f.type)
    if f.type == "bigint":
        number = _read(record, f, "decimal(38,0)", strict)
        return number.cast("bigint") if strict else number.try_cast("bigint")
    if f.type == "timestamp_ntz":
        if f.unit == "millis":
            return at_utc(F.timestamp_millis(_read(record, f, "bigint", strict)))
        if normalize_utc:
            return at_utc(_read(record, f, "timestamp", strict))
    return _read(record, f, f.type, strict)


def apply_length(value: Column, f: Field, on_long: str) -> Column:
    """Length rule of a string column: cut, fail, or leave for quarantine."""
    if f.length is None or f.type != "string":
        return value
    if on_long == "truncate":
        return F.substring(value, 1, f.length)
    if on_long == "fail":
        message = F.concat(F.lit(f"{f.name} is longer than {f.length}: "), value)
        return F.when(F.length(value) > f.length, F.raise_error(message).cast("string")).otherwise(value)
    if on_long == "quarantine":
        return value
    raise ValueError(f"unknown length policy {on_long!r}")


def _must_exist(value: Column, f: Field) -> Column:
    return F.coalesce(value, F.raise_error(F.lit(f"{f.name} is missing")).cast(f.type))


def typed(
    raw: DataFrame,
    spec: TableSpec,
    on_bad: str = "fail",
    on_long: str | None = None,
    normalize_utc: bool = False,
    keep_record: bool = False,
) -> DataFrame:
    """Typed rows of ``raw``, one per raw row, with the lineage columns a merge orders by.

    ``on_bad='fail'`` stops on a bad cast or a missing key. ``on_bad='quarantine'``
    keeps the row and lists the offending columns in ``_bad_fields``; ``split_bad``
    then parts the rows. A string over its length stops or is set aside likewise, unless ``on_long``
    says otherwise; it is cut only when ``on_long='truncate'`` asks for it. ``keep_record`` leaves the record itself in.
    """
    if on_bad not in ("fail", "quarantine"):
        raise ValueError(f"unknown cast policy {on_bad!r}")
    strict = on_bad == "fail"
    on_long = on_long or on_bad
    record = F.col(RECORD)
    columns, problems = [], []
    for f in spec.fields:
        value = cast_field(record, f, strict, normalize_utc)
        if f.name == spec.key and strict:
            value = _must_exist(value, f)
        # a key is never cut: two keys that differ behind the cut would become one
        rule = on_long
        if f.name == spec.key and on_long == "truncate":
            rule = "fail" if strict else "quarantine"
        columns.append(apply_length(value, f, rule).alias(f.name))
        if f.path is None:
            continue
        if not strict:
            bad = value.isNull()
            if f.name != spec.key:
                bad = bad & F.try_variant_get(record, f.path, "string").isNotNull()
            problems.append(F.when(bad, F.lit(f.name)))
        if rule == "quarantine" and f.type == "string" and f.length is not None:
            problems.append(F.when(F.length(value) > f.length, F.lit(f.name)))
    lineage = [F.col(c) for c in (*spec.change_names, LOADED_AT, SOURCE_FILE, BATCH_ID, POSITION)]
    if problems:
        columns.append(F.array_compact(F.array(*problems)).alias(BAD_FIELDS))
    if keep_record:
        lineage.append(record)
    return raw.select(*columns, *lineage)


def cut_fields(spec: TableSpec) -> Column:
    """Names of a raw row's string fields that ``on_long='truncate'`` cuts."""
    long = [f for f in spec.fields if f.path and f.type == "string" and f.length and f.name != spec.key]
    names = [F.when(F.length(F.try_variant_get(F.col(RECORD), f.path, "string")) > f.length, F.lit(f.name)) for f in long]
    return F.array_compact(F.array(*names))


def split_bad(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` of rows made with a quarantine policy."""
    has_problem = F.size(BAD_FIELDS) > 0
    return rows.filter(~has_problem).drop(BAD_FIELDS), rows.filter(has_problem)


def to_record_text(*columns: Column | str) -> Column:
    """JSON text of a row. Timestamps keep their microseconds."""
    return F.to_json(F.struct(*columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def convert_record(raw: DataFrame, spec: TableSpec, on_bad: str = "fail") -> DataFrame:
    """Records rewritten through the spec's schema: known fields only, in spec order, typed."""
    rows = raw.select(*[cast_field(F.col(RECORD), f, on_bad == "fail").alias(f.name) for f in spec.fields if f.path])
    return rows.select(F.col(spec.key), to_record_text(*rows.columns).alias("value"))
