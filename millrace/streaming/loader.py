"""Staged files to raw rows to the typed table, as Structured Streaming micro-batches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.records import NO_CHANGE_TIME, REASON, parse_lines, without_lead
from millrace.functions.typed import BAD_FIELDS, cut_fields, split_bad, typed
from millrace.operators.files import COPY, ERROR_DAYS, MERGE, audit_rows, failure_rows
from millrace.operators.merge import as_changes, now_ntz, reduce_batch
from millrace.sources.landing import UNKNOWN_OPERATION, change_time_of, epoch_millis_batch_id, operation_of, to_raw
from millrace.sources.polling import read_polled
from millrace.sources.pulls import PullState, incremental_pull, top_of
from millrace.sources.stage import as_in_metadata, batch_files, read_stage, record_position, with_line_numbers
from millrace.specs import LOADED_AT, OP_POLLED, POSITION_TYPE, RECORD, SOURCE_FILE, TableSpec
from millrace.storage import Store

DEFAULT_TRIGGER = {"processingTime": "1 minute"}


class BadRecords(RuntimeError):
    """A load with ``on_error='abort'`` met a bad record; nothing was written."""


@dataclass(frozen=True)
class LoadOptions:
    """How one feed is loaded."""

    on_error: str = "continue"
    on_bad: str = "fail"
    on_long: str = "quarantine"
    normalize_utc: bool = False
    merge: bool = True
    compact_every: int | None = None
    max_records_per_file: int | None = None
    load_ts: datetime | str | None = None

    def started(self) -> datetime | str:
        return self.load_ts or datetime.now(timezone.utc).replace(tzinfo=None)


def parsed_records(lines: DataFrame, spec: TableSpec) -> DataFrame:
    """Numbered lines parsed into records; a change log also needs a known operation and a time to order by."""
    parsed = parse_lines(with_line_numbers(lines))
    if spec.changelog:
        record = F.col("record")
        lacking = F.when(operation_of(record).isNull(), UNKNOWN_OPERATION).when(change_time_of(record).isNull(), NO_CHANGE_TIME)
        parsed = parsed.withColumn(REASON, F.coalesce(REASON, lacking))
    return parsed


def landed_of(parsed: DataFrame, spec: TableSpec, load_ts: datetime | str | None) -> DataFrame:
    """Raw rows of all parsed records; refused ones have no record but their text and the reason.

    A change log brings its own operation and time. Of an array only the refused item is kept as text.
    """
    refused = F.col(REASON).isNotNull()
    text = F.when(without_lead(F.col("value")).startswith("["), F.to_json("record"))
    parsed = parsed.withColumns(
        {"line": F.when(refused, F.coalesce(text, F.col("value"))), "record": F.when(~refused, F.col("record"))}
    )
    position, also = record_position(), ("line", REASON)
    if not spec.changelog:
        return to_raw(parsed, spec, OP_POLLED, load_ts, position=position, also=also)
    record = F.col("record")
    return to_raw(parsed, spec, operation_of(record), load_ts, cdc_ts=change_time_of(record), position=position, also=also)


def _errors(rows: DataFrame, load_ts: datetime | str) -> DataFrame:
    loaded = now_ntz(load_ts)
    return rows.select("line", SOURCE_FILE, "reason", loaded.alias(LOADED_AT), loaded.cast("date").alias("dt"))


# Stands before the text with which a load stops at its first refused record.
_ABORT = "refused record in ["


def copy_into_raw(
    store: Store, spec: TableSpec, lines: DataFrame, load_id: int, options: LoadOptions, load_ts: datetime | str
) -> None:
    """Appends the records of ``lines`` to the raw table as load ``load_id``, in one pass over the lines.

    Refused records go to the error area with their reason, or with ``on_error='abort'``
    the first one stops the load and nothing of it is seen.
    """
    if options.on_error not in ("continue", "abort"):
        raise ValueError(f"unknown error policy {options.on_error!r}")
    parsed = parsed_records(lines, spec)
    if options.on_error == "abort":
        stop = F.raise_error(F.concat(F.lit(_ABORT), F.col(SOURCE_FILE), F.lit(": "), F.col(REASON), F.lit("]")))
        parsed = parsed.withColumn(REASON, F.when(F.col(REASON).isNotNull(), stop.cast("string")))
    try:
        store.write_landed(landed_of(parsed, spec, load_ts), spec, load_id, options.max_records_per_file)
    except PySparkException as e:
        if options.on_error == "abort" and _ABORT in str(e):
            raise BadRecords(str(e).split(_ABORT, 1)[1].split("\n")[0].rsplit("]", 1)[0]) from e
        raise


def merge_load(
    store: Store, spec: TableSpec, raw: DataFrame, load_id: int, options: LoadOptions, load_ts: datetime | str
) -> None:
    """Writes the changes that load ``load_id`` brings to the typed table.

    Records set aside for a value go to the error area under the step ``cast``; records with a string that was cut are
    listed there under ``cut``. Both are read again only when there are any.
    """
    policy = (options.on_bad, options.on_long, options.normalize_utc)
    seen = Observation()
    aside, cut = F.lit(0).cast("long"), F.lit(0).cast("long")
    rows = typed(raw, spec, *policy)
    if BAD_FIELDS in rows.columns:
        aside = F.count_if(F.size(BAD_FIELDS) > 0)
    if options.on_long == "truncate":
        cut = F.count_if(F.size(cut_fields(spec)) > 0)
        rows = typed(raw, spec, *policy, keep_record=True)
    rows = rows.observe(seen, aside.alias("aside") if BAD_FIELDS in rows.columns else F.count_if(F.lit(False)).alias("aside"), cut.alias("cut") if options.on_long == "truncate" else F.count_if(F.lit(False)).alias("cut"))
    if BAD_FIELDS in rows.columns:
        rows, _ = split_bad(rows)
    changes = rows.drop(RECORD) if spec.changelog else as_changes(reduce_batch(rows.drop(RECORD), spec), spec, load_ts)
    store.write_changes(spec, changes, load_id)
    bad = long = None
    if seen.get["aside"]:
        _, bad = split_bad(typed(raw, spec, *policy, keep_record=True))
        bad = _told(bad, "bad value: ", F.col(BAD_FIELDS))
    if seen.get["cut"]:
        long = _told(raw.filter(F.size(cut_fields(spec)) > 0), "cut: ", cut_fields(spec))
    for step, errors in (("cast", bad), ("cut", long)):
        store.write_errors(spec, step, load_id, None if errors is None else _errors(errors, load_ts))


def _told(rows: DataFrame, what: str, fields: Column) -> DataFrame:
    return rows.withColumns({"line": F.to_json(RECORD), "reason": F.concat(F.lit(what), F.array_join(fields, ", "))})


def write_audit(
    store: Store, spec: TableSpec, load_id: int, started: datetime | str, ended: datetime | str, files: Sequence[str] = ()
) -> None:
    """Per-file counts of a load and its summaries, taken from what was written; a file of ``files`` without records has a row too."""
    listed = store.spark.createDataFrame([(f,) for f in files], "file string") if files else None
    rows = audit_rows(store.landed(spec, load_id), spec.raw_name, store.environment, started, ended, listed)
    store.write_load(rows, store.audit_path(spec), load_id)
    store.write_summaries(spec, load_id)


def files_of(lines: DataFrame) -> list[str]:
    """The files behind a batch frame, also those without a line."""
    return sorted({as_in_metadata(f) for f in lines.inputFiles()})


def _message(error: BaseException) -> str:
    """What an error says without the frames of its stack, so that its causes are not cut off."""
    lines = [line for line in str(error).split("\n") if line.strip() and not line.lstrip().startswith(("at ", "... "))]
    return "\n".join(dict.fromkeys(lines))


class _Failures:
    """Writes a row to the load history for each file of a try that fails; the failure itself goes on."""

    def __init__(self, store: Store, spec: TableSpec, load_id: int, started: datetime | str, files: Sequence[str]):
        self.store, self.spec, self.load_id, self.started, self.files = store, spec, load_id, started, files
        self.step = COPY

    def __enter__(self) -> _Failures:
        return self

    def __exit__(self, kind: Any, error: BaseException | None, trace: Any) -> None:
        if not isinstance(error, Exception):
            return
        rows = failure_rows(
            self.store.spark, self.spec.raw_name, self.store.environment, self.step, list(self.files) or [None], _message(error), self.started
        )
        self.store.write_failure(self.spec, self.load_id, rows)


def load_batch(
    store: Store, spec: TableSpec, lines: DataFrame, load_id: int, options: LoadOptions, files: Sequence[str] | None = None
) -> None:
    """One load from lines to raw rows, audit and typed changes; repeating it is safe.

    ``files`` names the batch's files where the frame itself does not. A try that fails leaves
    rows in the load history, whatever becomes of the load later.
    """
    started = options.started()
    files = files_of(lines) if files is None else files
    with _Failures(store, spec, load_id, started, files) as trying:
        copy_into_raw(store, spec, lines, load_id, options, started)
        write_audit(store, spec, load_id, started, options.started(), files)
        if options.merge:
            trying.step = MERGE
            merge_load(store, spec, store.raw(spec, load_id), load_id, options, started)
            if options.compact_every:
                base = store.base_version(spec)
                if load_id - (-1 if base is None else base) >= options.compact_every:
                    store.compact(spec)


def start_stream(
    store: Store,
    stage_root: str,
    spec: TableSpec,
    trigger: dict[str, Any] | None = None,
    options: LoadOptions = LoadOptions(),
    whole: bool = False,
    **rate: str | int,
) -> StreamingQuery:
    """Loads a feed's staged files, each once, and merges them into its typed table.

    ``trigger`` is the writer's own, once a minute unless given; ``{'availableNow': True}``
    loads what is there and stops. ``rate`` takes ``maxFilesPerTrigger`` and the like.
    A restarted query goes on where the last one stopped and repeats an unfinished load
    under the same id.
    """
    generation = PullState(store.spark, store.root).get(stream_feed(spec))["generation"]
    lines = read_stage(store.spark, stage_root, spec.namespace, spec.name, stream=True, whole=whole, **rate)

    checkpoint = store.checkpoint_path(spec, generation)

    def body(batch: DataFrame, batch_id: int) -> None:
        files = batch_files(store.spark, checkpoint, batch_id)
        load_batch(store, spec, batch, store.load_id(spec, "stream", f"{generation}/{batch_id}"), options, files)

    return (
        lines.writeStream.foreachBatch(body)
        .queryName(f"load_{spec.namespace}_{spec.folder}_{generation}")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .start()
    )


def stream_feed(spec: TableSpec) -> str:
    return f"stream_{spec.namespace}_{spec.folder}"


def reset_stream(store: Store, spec: TableSpec) -> None:
    """Forgets which files were loaded: the next start loads them all again."""
    PullState(store.spark, store.root).reset(stream_feed(spec))


def pull_feed(spec: TableSpec) -> str:
    return f"pull_{spec.namespace}_{spec.folder}"


def load_rows(
    store: Store, spec: TableSpec, rows: DataFrame, load_id: int, options: LoadOptions, cursor_col: str
) -> tuple[int, Any]:
    """One load of rows of a source table: raw rows, audit and typed changes. How many there were, and their largest cursor."""
    started, name = options.started(), f"{spec.namespace}/{spec.name}"
    with _Failures(store, spec, load_id, started, [name]) as trying:
        seen = Observation()
        top = top_of(rows, cursor_col)
        record = F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("record")
        records = rows.observe(seen, F.count(F.lit(1)).alias("n"), top.alias("top")).select(record, F.lit(name).alias(SOURCE_FILE))
        no_position = F.lit(None).cast(POSITION_TYPE)
        raw = to_raw(records, spec, OP_POLLED, started, epoch_millis_batch_id(started), position=no_position)
        store.write_landed(raw, spec, load_id, options.max_records_per_file)
        if seen.get["n"]:
            write_audit(store, spec, load_id, started, options.started())
            if options.merge:
                trying.step = MERGE
                merge_load(store, spec, store.raw(spec, load_id), load_id, options, started)
    return seen.get["n"], seen.get["top"]


def pull_once(
    store: Store,
    spec: TableSpec,
    source: DataFrame,
    cursor_col: str,
    overlap: timedelta | int | None = None,
    options: LoadOptions = LoadOptions(),
) -> Any:
    """One poll of a source table: rows past the mark of ``cursor_col`` become raw rows and typed changes.

    The mark may be of any type that orders. It moves only after everything is written; a crash
    before that makes the next poll read the same rows again under the same load id. Rows without a
    cursor come with every poll. Returns the mark after the poll, or None when no row came.
    """
    state = PullState(store.spark, store.root)
    feed = pull_feed(spec)
    mark = state.get(feed)
    load_id = store.load_id(spec, "pull", f"{mark['generation']}/{mark['seq']}")
    fresh = incremental_pull(source, cursor_col, mark["hwm"], overlap, keep_null=True)
    n, top = load_rows(store, spec, fresh, load_id, options, cursor_col)
    if not n:
        return None
    state.advance(feed, top, str(load_id))
    return state.get(feed)["hwm"]


def start_poll(
    store: Store,
    spec: TableSpec,
    path: str,
    cursor_col: str,
    trigger: dict[str, Any] | None = None,
    options: LoadOptions = LoadOptions(),
) -> StreamingQuery:
    """Polls a Parquet table that grows, as a stream whose offsets are the marks of ``cursor_col``.

    Marks, restart and the repeat of an unfinished poll are Spark's; ``reset_pull`` gives the next start a new
    checkpoint, so that it reads everything again.
    """
    generation = PullState(store.spark, store.root).get(pull_feed(spec))["generation"]

    def body(batch: DataFrame, batch_id: int) -> None:
        load_rows(store, spec, batch, store.load_id(spec, "poll", f"{generation}/{batch_id}"), options, cursor_col)

    return (
        read_polled(store.spark, path, cursor_col)
        .writeStream.foreachBatch(body)
        .queryName(f"poll_{spec.namespace}_{spec.folder}_{generation}")
        .option("checkpointLocation", f"{store.root}/checkpoints/poll_{spec.folder}/generation={generation}")
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .start()
    )


def reset_pull(store: Store, spec: TableSpec) -> None:
    """Forgets the mark: the next poll, or the next start of a polling stream, reads the whole source again."""
    PullState(store.spark, store.root).reset(pull_feed(spec))


def maintain(store: Store, spec: TableSpec, now: datetime | str, raw_days: int | None = None, error_days: int = ERROR_DAYS) -> dict[str, Any]:
    """What keeps a table's folders few, once a day and not beside its loads; says what was done.

    Folds the days that are over, writes a new base, removes old bases, errors past their time, and with ``raw_days``
    raw rows older than that.
    """
    today = datetime.fromisoformat(str(now)).date()
    done: dict[str, Any] = {"folded": store.fold_days(spec, today), "base": store.compact(spec), "pruned": store.prune(spec)}
    done["expired errors"] = store.expire_errors(spec, now, error_days)
    if raw_days is not None:
        done["expired days"] = store.expire_days(spec, today - timedelta(days=raw_days))
    return done
