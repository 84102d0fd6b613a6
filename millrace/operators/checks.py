"""Data checks: conformance, required values, keys, references, arrivals."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.typed import cast_field
from millrace.operators.merge import fits_broadcast
from millrace.specs import RAW_KEY, RECORD, RECORD_ID_LENGTHS, Field, TableSpec

# Fixed value: share of expected rows that must have arrived.
COMPLETE_SHARE = 0.95

# Longer key lists are joined instead of written into the filter.
IN_LIST_MAX = 1000


def _stacked(wide: DataFrame, names: Sequence[str], measures: Sequence[str], label: str) -> DataFrame:
    """One row per name out of columns ``<measure>__<i>``."""
    parts = []
    for i, name in enumerate(names):
        parts.append(", ".join([f"'{name}'", *[f"{m}__{i}" for m in measures]]))
    titles = ", ".join([label, *measures])
    return wide.selectExpr("n_rows", f"stack({len(names)}, {', '.join(parts)}) as ({titles})")


def field_conformance(raw: DataFrame, fields: Iterable[Field], record: str = RECORD) -> DataFrame:
    """Per expected field: rows, rows without a value, rows whose value does not cast."""
    fields = [f for f in fields if f.path]
    aggregates: list[Column] = [F.count("*").alias("n_rows")]
    for i, f in enumerate(fields):
        absent = F.try_variant_get(F.col(record), f.path, "string").isNull()
        uncast = cast_field(F.col(record), f, strict=False).isNull()
        aggregates.append(F.count_if(absent).alias(f"n_null__{i}"))
        aggregates.append(F.count_if(~absent & uncast).alias(f"n_bad__{i}"))
    wide = raw.agg(*aggregates)
    return _stacked(wide, [f.name for f in fields], ["n_null", "n_bad"], "field")


def column_conformance(df: DataFrame, expected: StructType) -> DataFrame:
    """Per expected column: whether it is there with its type, rows, rows where it is NULL, and strings over their length.

    One pass over the table, whatever the number of columns; counts of a column that is not there are NULL.
    """
    found = {f.name.lower(): f for f in df.schema.fields}
    aggregates, states = [F.count("*").alias("n_rows")], []
    for i, f in enumerate(expected.fields):
        own = found.get(f.name.lower())
        limit = (f.metadata or {}).get("max_length")
        is_long = F.count_if(F.length(f.name) > limit) if own is not None and limit and own.dataType == f.dataType else F.lit(0).cast("long")
        unknown = F.lit(None).cast("long")
        aggregates += [
            (unknown if own is None else F.count_if(F.col(f.name).isNull())).alias(f"n_null__{i}"),
            (unknown if own is None else is_long).alias(f"n_long__{i}"),
        ]
        states.append((own is not None, own is not None and own.dataType == f.dataType))
    wide = df.agg(*aggregates)
    for i, (is_there, has_type) in enumerate(states):
        wide = wide.withColumns({f"is_there__{i}": F.lit(is_there), f"has_type__{i}": F.lit(has_type)})
    return _stacked(wide, expected.names, ["is_there", "has_type", "n_null", "n_long"], "column_name")


def required_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per required column: rows and rows where it is NULL."""
    aggregates = [F.count("*").alias("n_rows")]
    aggregates += [F.count_if(F.col(c).isNull()).alias(f"n_null__{i}") for i, c in enumerate(columns)]
    return _stacked(df.agg(*aggregates), columns, ["n_null"], "column_name")


def id_length_ok(record_id: Column) -> Column:
    return F.coalesce(F.length(record_id).isin(*RECORD_ID_LENGTHS), F.lit(False))


def id_length_check(raw: DataFrame, path: str = "$.Id") -> DataFrame:
    """Rows whose record id is there and 15 or 18 characters long, and the others."""
    ok = id_length_ok(F.try_variant_get(F.col(RECORD), path, "string"))
    return raw.agg(F.count("*").alias("n_rows"), F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_bad"))


def raw_key(spec: TableSpec) -> Column:
    """The key inside a raw record, for filters on raw rows that were never stored."""
    key = spec.field(spec.key)
    return F.variant_get(F.col(RECORD), key.path, key.type)


def key_of(raw: DataFrame, spec: TableSpec) -> Column:
    """The key of raw rows: their real column where they have one, which Parquet can skip by, else the path."""
    return F.col(RAW_KEY) if RAW_KEY in raw.columns else raw_key(spec)


def raw_point_lookup(raw: DataFrame, spec: TableSpec, key: int | str) -> DataFrame:
    """Raw rows of one key. Of a stored raw table only row groups are read whose key range and bloom filter may hold it."""
    return raw.filter(key_of(raw, spec) == F.lit(key))


def raw_in_list(raw: DataFrame, spec: TableSpec, keys: Sequence[int | str] | DataFrame) -> DataFrame:
    """Raw rows whose key is listed; long lists and key tables become a semi join.

    A list's length is known, so a list that fits is broadcast and ``raw`` stays where it
    is. A key table is shuffled, or broadcast by Spark once it has seen its size.
    """
    if not isinstance(keys, DataFrame):
        # keys may come as text; a list of any length reads them as the key's type
        type_ = spec.typed_schema[spec.key].dataType.simpleString()
        if len(keys) <= IN_LIST_MAX:
            return raw.filter(key_of(raw, spec).isin([F.lit(str(k)).cast(type_) for k in keys]))
        listed = raw.sparkSession.createDataFrame([(str(k),) for k in keys], "k string").select(F.col("k").cast(type_).alias(spec.key))
        keys = F.broadcast(listed) if fits_broadcast(spec, len(keys)) else listed
    return raw.join(keys.select(F.col(spec.key).alias("_wanted")), key_of(raw, spec) == F.col("_wanted"), "left_semi")


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Rows and distinct keys of a table, and whether they agree.

    Rows are counted per key first, so a frequent key is one small row by the time
    anything is shuffled.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(key).alias("n_keys"),
        F.coalesce(F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)), F.lit(0)).alias("n_repeated"),
    ).withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose reference matches no parent; rows without a reference are fine.

    Both sides of the join are plain shuffles, so adaptive execution can split a
    reference that much of the child shares.
    """
    known = parent.select(F.col(pk).alias("_known"))
    return child.filter(F.col(fk).isNotNull()).join(known, F.col(fk) == F.col("_known"), "left_anti")


def missing_ids(expected: DataFrame, raw: DataFrame, key: str) -> DataFrame:
    """Expected keys with no row in ``raw``."""
    return expected.select(key).distinct().join(raw.select(key).distinct(), key, "left_anti")


def arrived(expected: DataFrame, raw: DataFrame, key: str) -> DataFrame:
    """How many distinct expected keys have at least one row in ``raw``."""
    seen = raw.select(key).distinct().join(expected.select(key), key, "left_semi")
    return seen.agg(F.count(key).alias("n_arrived"))


def completeness(expected: DataFrame, raw: DataFrame, key: str, share: float = COMPLETE_SHARE) -> DataFrame:
    """Expected and arrived keys, their ratio, and whether enough arrived."""
    marked = (
        expected.select(key)
        .distinct()
        .join(raw.select(key).distinct().withColumn("_seen", F.lit(1)), key, "left")
        .agg(F.count("*").alias("n_expected"), F.count("_seen").alias("n_arrived"))
    )
    return marked.withColumn("ratio", F.col("n_arrived") / F.nullif("n_expected", F.lit(0))).withColumn(
        "is_complete", F.col("n_arrived") >= F.col("n_expected") * share
    )


def active_rows(df: DataFrame) -> DataFrame:
    """Rows not flagged as deleted."""
    return df.filter(F.col("is_deleted") == F.lit(False))


def non_empty(df: DataFrame) -> bool:
    """Whether there is any row; stops at the first one found."""
    return not df.isEmpty()


def non_empty_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table, whether it holds any row; one row at most is taken from each."""
    parts = [
        df.limit(1).agg((F.count("*") > 0).alias("has_rows")).select(F.lit(name).alias("table_name"), "has_rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
