"""Keyed merge: update on match, insert otherwise, with two column lists and late-row protection."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.latest import latest_per_key
from millrace.specs import (
    BATCH_ID,
    ETL_BATCH_ID,
    ETL_LOADED_AT,
    LINEAGE_OP,
    LINEAGE_TS,
    LOAD_ID,
    LOADED_AT,
    OP_DELETE,
    TableSpec,
)

# A merge source up to this size (row bound times row width) is broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


def now_ntz(load_ts: datetime | str | Column | None = None) -> Column:
    """The load time: the given one, or the clock's."""
    if isinstance(load_ts, Column):
        return load_ts
    if load_ts is None:
        return F.localtimestamp()
    return F.lit(str(load_ts)).cast("timestamp_ntz")


def reduce_batch(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """One typed source row per key: the newest by the spec's order."""
    return latest_per_key(rows, [spec.key], spec.order_names)


def as_changes(rows: DataFrame, spec: TableSpec, load_ts: datetime | str | None = None, *also: str) -> DataFrame:
    """Typed source rows with the columns the target stores, load time and batch included, and ``also``."""
    return rows.select(
        *[F.col(f.name) for f in spec.fields],
        *spec.change_names,
        now_ntz(load_ts).alias(ETL_LOADED_AT),
        F.col(BATCH_ID).alias(ETL_BATCH_ID),
        *also,
    )


def _updated_names(spec: TableSpec) -> tuple[str, ...]:
    return (*spec.updated, *spec.change_names, ETL_LOADED_AT, ETL_BATCH_ID)


def _inserted_value(spec: TableSpec, name: str, source: str) -> Column:
    written = (*spec.inserted, *spec.change_names, ETL_LOADED_AT, ETL_BATCH_ID)
    type_ = spec.typed_schema[name].dataType
    if name == "is_deleted":
        given = F.col(f"{source}.{name}") if spec.carries_deleted else F.lit(None).cast(type_)
        return F.coalesce(given, F.lit(False))
    return F.col(f"{source}.{name}") if name in written else F.lit(None).cast(type_)


def _order_struct(spec: TableSpec, side: str) -> Column:
    # Struct order puts NULL lowest and is never NULL itself.
    return F.struct(*[F.col(f"{side}.{c}") for c in spec.guard_names])


def require_key(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """``rows``, failing on one without a key.

    The check is a filter, so the key column itself passes through untouched and keeps
    whatever partitioning the rows already have.
    """
    missing = F.raise_error(F.lit(f"{spec.name}: a row without {spec.key} reached the merge")).cast("boolean")
    return rows.filter(F.when(F.col(spec.key).isNull(), missing).otherwise(F.lit(True)))


def _key_column(spec: TableSpec, *sides: str) -> Column:
    keys = [F.col(f"{s}.{spec.key}") for s in sides]
    return (F.coalesce(*keys) if len(keys) > 1 else keys[0]).alias(spec.key)


def _matched_value(spec: TableSpec, name: str, applies: Column) -> Column:
    if name not in _updated_names(spec):
        return F.col(f"t.{name}")
    new = F.col(f"s.{name}")
    if name == "is_deleted":
        new = F.coalesce(new, F.lit(False))
    return F.when(applies, new).otherwise(F.col(f"t.{name}"))


def fits_broadcast(spec: TableSpec, source_rows: int | None) -> bool:
    """True when ``source_rows`` rows of the widest kind stay under the broadcast bound."""
    return source_rows is not None and source_rows * spec.row_bytes() <= BROADCAST_BYTES


def _combine(
    target: DataFrame,
    source: DataFrame,
    spec: TableSpec,
    kept: dict[str, Column],
    new: dict[str, Column],
    small: bool,
    insertable: Column | None = None,
    in_place: bool = False,
) -> DataFrame:
    """Target rows with their source row applied, and the source rows of new keys.

    Both sides hold a key once. ``kept`` and ``new`` give each column but the key, over
    the sides ``t`` and ``s``; ``insertable`` says which source rows may become new ones.
    A target ``in_place`` is stored by key: only the source is shuffled, to where the target's
    rows are, and read once; a ``small`` one is hashed there, so the target is not sorted.
    Of another target a ``small`` source is broadcast and the target stays where it is.
    """
    names = [c for c in spec.typed_columns if c != spec.key]
    same_key = F.col(f"t.{spec.key}") == F.col(f"s.{spec.key}")
    marked = source.withColumn("_here", F.lit(True))
    if in_place and small:
        marked = marked.hint("shuffle_hash")
    if small and not in_place:
        joined = target.alias("t").join(F.broadcast(marked).alias("s"), same_key, "left")
        # Keys found in the target are at most the source's own, so they broadcast too.
        hits = target.select(spec.key).join(F.broadcast(source.select(spec.key)), spec.key, "left_semi")
        fresh = source.join(F.broadcast(hits), spec.key, "left_anti").alias("s")
        if insertable is not None:
            fresh = fresh.filter(insertable)
        return joined.select(_key_column(spec, "t"), *[kept[c].alias(c) for c in names]).unionByName(
            fresh.select(_key_column(spec, "s"), *[new[c].alias(c) for c in names])
        )
    in_target = F.col("t._here").isNotNull()
    joined = target.withColumn("_here", F.lit(True)).alias("t").join(marked.alias("s"), same_key, "full_outer")
    if insertable is not None:
        joined = joined.filter(in_target | insertable)
    return joined.select(
        _key_column(spec, "t", "s"), *[F.when(in_target, kept[c]).otherwise(new[c]).alias(c) for c in names]
    )


def merge_changes(
    target: DataFrame,
    changes: DataFrame,
    spec: TableSpec,
    guard: bool = True,
    source_rows: int | None = None,
    in_place: bool = False,
) -> DataFrame:
    """``target`` after merging ``changes`` that hold one row per key (``as_changes`` form).

    With ``source_rows``, an upper bound of the number of changes, a small source is
    broadcast and the target is not shuffled. Without it, or beyond the bound, both
    sides are shuffled on the key; each key occurs once per side, so no key is hot.
    A target ``in_place``, bucketed by its key, is not shuffled either way.
    """
    applies = F.col("s._here") & _guarded(spec, guard)
    kept = {c: _matched_value(spec, c, applies) for c in spec.typed_columns}
    new = {c: _inserted_value(spec, c, "s") for c in spec.typed_columns if c != spec.key}
    return _combine(target, require_key(changes, spec), spec, kept, new, fits_broadcast(spec, source_rows), in_place=in_place)


def _guarded(spec: TableSpec, guard: bool) -> Column:
    return _order_struct(spec, "s") >= _order_struct(spec, "t") if guard else F.lit(True)


def _insert_columns(spec: TableSpec) -> list[Column]:
    return [
        _key_column(spec, "s") if c == spec.key else _inserted_value(spec, c, "s").alias(c)
        for c in spec.typed_columns
    ]


def insert_all(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """The merge into an empty target."""
    return require_key(changes, spec).alias("s").select(*_insert_columns(spec))


def merge_upsert(
    target: DataFrame | None,
    source: DataFrame,
    spec: TableSpec,
    guard: bool = True,
    load_ts: datetime | str | None = None,
    source_rows: int | None = None,
) -> DataFrame:
    """``target`` after merging the typed rows of one batch, any number per key.

    The batch is first cut to one row per key. A key of the target is updated in the
    spec's ``updated`` columns, a new key is inserted with its ``inserted`` columns.
    ``guard`` keeps a target row that is newer than the batch's; without it the batch
    always wins. ``target`` None stands for an empty table.
    """
    changes = as_changes(reduce_batch(source, spec), spec, load_ts)
    if target is None:
        return insert_all(changes, spec)
    return merge_changes(target, changes, spec, guard, source_rows)


def fold_loads(changes: DataFrame, spec: TableSpec, guard: bool = True) -> DataFrame:
    """Changes of many loads folded to one row per key, as merging them in turn would.

    ``changes`` is in ``as_changes`` form plus ``_load_id``, one row per key and load.
    Columns a merge only inserts come from the key's first load, the others from the
    load that wins the guard (the last load without it). One shuffle however many
    loads there are.
    """
    updated = [c for c in _updated_names(spec) if c in changes.columns]
    first_only = [c for c in changes.columns if c not in updated and c not in (spec.key, LOAD_ID)]
    rank = F.struct(*[F.col(c) for c in spec.guard_names], F.col(LOAD_ID)) if guard else F.struct(LOAD_ID)
    aggregates = [F.max_by(F.struct(*updated), rank).alias("_last")]
    if first_only:
        aggregates.append(F.min_by(F.struct(*first_only), F.col(LOAD_ID)).alias("_first"))
    folded = changes.groupBy(spec.key).agg(*aggregates)
    source = {**{c: f"_last.{c}" for c in updated}, **{c: f"_first.{c}" for c in first_only}, spec.key: spec.key}
    return folded.select(*[F.col(source[c]).alias(c) for c in changes.columns if c != LOAD_ID])


def net_changes(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """What a change log comes to, one row per key.

    ``_last`` tells the last change, ``_data`` the last one that carries data and
    ``_first`` the values only inserted, of the first one that does. A key with much of
    the log is cut to one row per task before the shuffle.
    """
    order = F.struct(*[F.col(c) for c in spec.order_names])
    # A NULL order is passed over, so deletes never supply data columns.
    data_order = F.when(F.col(LINEAGE_OP) != OP_DELETE, order)
    return (
        require_key(changes, spec)
        .groupBy(spec.key)
        .agg(
            F.max_by(F.struct(LINEAGE_OP, LINEAGE_TS, spec.cursor, LOADED_AT, BATCH_ID), order).alias("_last"),
            F.max_by(F.struct(*spec.updated, F.col(LINEAGE_TS).alias("_data_ts")), data_order).alias("_data"),
            F.min_by(F.struct(*_first_only(spec)), data_order).alias("_first"),
        )
    )


def _first_only(spec: TableSpec) -> list[str]:
    return [c for c in spec.insert_only if c != "is_deleted"]


def apply_changelog(
    target: DataFrame | None,
    changes: DataFrame,
    spec: TableSpec,
    keep_tombstones: bool = False,
    load_ts: datetime | str | None = None,
    source_rows: int | None = None,
    in_place: bool = False,
) -> DataFrame:
    """``target`` after applying insert, update and delete changes in log order.

    ``changes`` are typed rows whose ``_cdc_operation`` tells the kind. A delete keeps
    the row and sets ``is_deleted``; its data columns stay. A later insert or update
    clears the flag. Columns only inserted come from the first change that carries
    data. A delete of a key never seen makes a row only with ``keep_tombstones``.
    Changes older than the target row are ignored. The load time is the last change's
    own unless ``load_ts`` is given. ``source_rows`` and ``in_place`` work as in ``merge_changes``.
    """
    last_ts, data_ts = F.col(f"s._last.{LINEAGE_TS}"), F.col("s._data._data_ts")
    not_older = F.col("s._here") & (F.struct(last_ts) >= F.struct(F.col(f"t.{LINEAGE_TS}")))
    data_not_older = F.col("s._data").isNotNull() & (F.struct(data_ts) >= F.struct(F.col(f"t.{LINEAGE_TS}")))
    from_last = {
        "is_deleted": F.col(f"s._last.{LINEAGE_OP}") == OP_DELETE,
        LINEAGE_OP: F.col(f"s._last.{LINEAGE_OP}"),
        LINEAGE_TS: last_ts,
        ETL_LOADED_AT: F.col(f"s._last.{LOADED_AT}") if load_ts is None else now_ntz(load_ts),
        ETL_BATCH_ID: F.col(f"s._last.{BATCH_ID}"),
    }
    kept, new = {}, {}
    for c in spec.typed_columns:
        old = F.col(f"t.{c}")
        if c in from_last:
            new[c] = from_last[c]
            kept[c] = F.when(not_older, new[c]).otherwise(old)
        elif c == spec.cursor:
            carried, data = F.col(f"s._last.{c}"), F.col(f"s._data.{c}")
            new[c] = F.coalesce(carried, data)
            kept[c] = F.when(not_older, F.coalesce(carried, F.when(data_not_older, data), old)).otherwise(old)
        elif c in spec.updated:
            new[c] = F.col(f"s._data.{c}")
            kept[c] = F.when(data_not_older, new[c]).otherwise(old)
        elif c in _first_only(spec):
            new[c], kept[c] = F.col(f"s._first.{c}"), old
        else:
            new[c], kept[c] = F.lit(None).cast(spec.typed_schema[c].dataType), old
    net = net_changes(changes, spec)
    insertable = None if keep_tombstones else F.col("s._data").isNotNull()
    if target is None:
        rows = net.alias("s") if insertable is None else net.alias("s").filter(insertable)
        return rows.select(_key_column(spec, "s"), *[new[c].alias(c) for c in spec.typed_columns if c != spec.key])
    # A net row holds up to two of the widest rows.
    small = source_rows is not None and fits_broadcast(spec, 2 * source_rows)
    return _combine(target, net, spec, kept, new, small, insertable, in_place)


def merge_into_table(table: str, changes: DataFrame, spec: TableSpec, guard: bool = True) -> None:
    """The same merge for a catalog table that supports row-level operations.

    ``changes`` holds one row per key. Parquet tables do not support this; use
    ``merge_changes`` there.
    """
    source = changes.alias("s")
    target_key = F.col(f"{table}.{spec.key}")
    sets = {c: F.col(f"s.{c}") for c in _updated_names(spec)}
    inserts = {c: _inserted_value(spec, c, "s") for c in spec.typed_columns}
    newer = F.struct(*[F.col(f"s.{c}") for c in spec.guard_names]) >= F.struct(
        *[F.col(f"{table}.{c}") for c in spec.guard_names]
    )
    writer = source.mergeInto(table, target_key == F.col(f"s.{spec.key}"))
    matched = writer.whenMatched(newer) if guard else writer.whenMatched()
    matched.update(sets).whenNotMatched().insert(inserts).merge()
