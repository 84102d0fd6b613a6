"""Where the raw, error, audit and typed data of one environment lie."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.folders import folder_bytes, folder_names, path_exists, remove_folder
from millrace.functions.typed import cast_field
from millrace.loads import LoadIds
from millrace.operators.files import ERROR_DAYS
from millrace.operators.merge import apply_changelog, fold_loads, insert_all, merge_changes
from millrace.operators.sketches import SUMMARY_SCHEMA, merged_summaries, summaries
from millrace.specs import (
    BATCH_ID,
    LINEAGE_OP,
    LINEAGE_TS,
    LOAD_ID,
    LOADED_AT,
    POSITION,
    POSITION_TYPE,
    RAW_CURSOR,
    RAW_KEY,
    RECORD,
    SOURCE_FILE,
    TableSpec,
)

LOAD_FIELD = T.StructField(LOAD_ID, T.LongType())

# How a landed record came out, and the day of its load.
OUTCOME, GOOD, BAD = "_outcome", "good", "bad"
DAY = "_day"

# Bytes of a file of a folded day, about.
FOLDED_FILE_BYTES = 512 * 1024 * 1024
# What one task sorts of a fold: rows, and their bytes as they lie on disk, which may be some thirtieth of what they are in memory.
FOLDED_TASK_ROWS, FOLDED_TASK_BYTES = 500_000, 64 * 1024 * 1024
# Values of a key column in one file that its bloom filter is made for, and how often that says yes for nothing.
BLOOM_KEYS, BLOOM_ERROR = 1_000_000, 0.01

# Columns of the error area.
ERROR_SCHEMA = T.StructType(
    [
        T.StructField("line", T.StringType()),
        T.StructField(SOURCE_FILE, T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField(LOADED_AT, T.TimestampNTZType()),
        T.StructField("dt", T.DateType()),
        T.StructField("step", T.StringType()),
        LOAD_FIELD,
    ]
)

# Which version's folder holds each bucket of a base; ``made`` names the base for the session's catalog.
MANIFEST_SCHEMA = T.StructType(
    [
        LOAD_FIELD,
        T.StructField("made", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("version", T.LongType()),
    ]
)

# Rows of a bucket, about, when a base is first dealt into buckets; dealt anew when it has four times as many.
BUCKET_ROWS = 4_000_000
BUCKET = "_bucket"
# Spark takes no more buckets than this.
MOST_BUCKETS = 65_536

# Columns of the load history.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField("query_type", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("row_parsed", T.LongType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("error_count", T.LongType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("last_load_time", T.TimestampNTZType()),
        LOAD_FIELD,
    ]
)


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a key: the partition that Spark's hash partitioning and bucketing give it."""
    return F.pmod(F.hash(key), F.lit(buckets))


def if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The Parquet data at ``path``, or None when nothing was ever written there."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None


def landed_schema(spec: TableSpec) -> T.StructType:
    """Good and refused records of a load as they lie on disk.

    The key and the cursor are real columns beside the record, so that Parquet skips what a filter on them rules out.
    """
    out = T.StructType(list(spec.raw_schema.fields))
    key, cursor = (T.DataType.fromDDL(spec.field(c).type) for c in (spec.key, spec.cursor))
    return out.add(RAW_KEY, key).add(RAW_CURSOR, cursor).add("line", T.StringType()).add("reason", T.StringType())


def stored_raw_schema(spec: TableSpec) -> T.StructType:
    """A raw row as it is read: the record with its lineage, the real columns, and its load."""
    own = [f for f in landed_schema(spec).fields if f.name not in ("line", "reason")]
    return T.StructType([*own, LOAD_FIELD])


def bloom_options(column: str) -> dict[str, str]:
    return {
        f"parquet.bloom.filter.enabled#{column}": "true",
        f"parquet.bloom.filter.expected.ndv#{column}": str(BLOOM_KEYS),
        f"parquet.bloom.filter.fpp#{column}": str(BLOOM_ERROR),
        "parquet.bloom.filter.adaptive.enabled": "true",
    }


def with_load_id(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, LOAD_FIELD])


def change_schema(spec: TableSpec) -> T.StructType:
    """Rows kept per load for the typed table: reduced changes, or a change log's typed rows."""
    fields = [T.StructField(f.name, T.DataType.fromDDL(f.type)) for f in spec.fields]
    typed = {f.name: f for f in spec.typed_schema.fields}
    if spec.changelog:
        fields += [T.StructField(LINEAGE_OP, T.StringType()), T.StructField(LINEAGE_TS, T.TimestampNTZType())]
        fields += [T.StructField(LOADED_AT, T.TimestampNTZType())]
        fields += [T.StructField(c, T.StringType()) for c in (SOURCE_FILE, BATCH_ID)]
        fields += [T.StructField(POSITION, POSITION_TYPE)]
    else:
        fields += [typed[c] for c in (*spec.change_names, "_etl_loaded_at", "_etl_batch_id")]
    return T.StructType(fields)


class Store:
    """Folders of one environment under ``root``.

    Every load writes its own ``_load_id=<n>`` folders and overwrites them when it is
    repeated, so a repeated load changes nothing. A typed table is its last base plus
    the changes of later loads, merged when read; ``compact`` writes a new base. A load
    so costs what it brings, not what the table holds.

    A base lies in buckets by the hash of its key. A new base writes only the buckets that
    changed and takes the files of the others over; merging joins it bucket by bucket,
    without shuffling it.
    """

    def __init__(self, spark: SparkSession, root: str, environment: str = "dev", bucket_rows: int = BUCKET_ROWS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.environment = environment
        self.bucket_rows = bucket_rows

    # -- folders ---------------------------------------------------------

    def raw_path(self, spec: TableSpec) -> str:
        """Landed records by load and outcome, until their day is folded."""
        return f"{self.root}/raw/{spec.folder}_raw"

    def days_path(self, spec: TableSpec) -> str:
        """Raw rows of folded loads by day."""
        return f"{self.root}/raw_days/{spec.folder}_raw"

    def errors_path(self, spec: TableSpec) -> str:
        return f"{self.root}/errors/{spec.folder}"

    def audit_path(self, spec: TableSpec) -> str:
        return f"{self.root}/audit/{spec.folder}"

    def failures_path(self, spec: TableSpec) -> str:
        return f"{self.root}/failures/{spec.folder}"

    def summaries_path(self, spec: TableSpec) -> str:
        return f"{self.root}/summaries/{spec.folder}"

    def base_path(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.namespace}/{spec.folder}/base"

    def bases_path(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.namespace}/{spec.folder}/bases"

    def checkpoint_path(self, spec: TableSpec, generation: int) -> str:
        return f"{self.root}/checkpoints/{spec.folder}/generation={generation}"

    def write_load(
        self, df: DataFrame, path: str, load_id: int, max_records: int | None = None, by: str | None = None
    ) -> None:
        writer = df.write.mode("overwrite")
        if max_records:
            writer = writer.option("maxRecordsPerFile", max_records)
        if by:
            writer = writer.partitionBy(by)
        writer.parquet(f"{path}/{LOAD_ID}={load_id}")

    def write_landed(
        self, rows: DataFrame, spec: TableSpec, load_id: int, max_records: int | None = None
    ) -> None:
        """Records of a load in one job, parted by outcome and sorted by key; a repeat overwrites them.

        ``rows`` has the raw columns, and ``reason`` and ``line`` where records were refused.
        """
        if "reason" not in rows.columns:
            rows = rows.withColumns({"reason": F.lit(None).cast("string"), "line": F.lit(None).cast("string")})
        record = F.col(RECORD)
        rows = rows.select(
            *spec.raw_schema.names,
            cast_field(record, spec.field(spec.key), strict=False).alias(RAW_KEY),
            cast_field(record, spec.field(spec.cursor), strict=False).alias(RAW_CURSOR),
            "line",
            "reason",
            F.when(F.col("reason").isNull(), GOOD).otherwise(BAD).alias(OUTCOME),
        )
        writer = rows.sortWithinPartitions(OUTCOME, RAW_KEY).write.mode("overwrite").partitionBy(OUTCOME)
        writer = writer.options(**bloom_options(RAW_KEY))
        if max_records:
            writer = writer.option("maxRecordsPerFile", max_records)
        writer.parquet(f"{self.raw_path(spec)}/{LOAD_ID}={load_id}")

    def write_errors(self, spec: TableSpec, step: str, load_id: int, errors: DataFrame | None) -> None:
        """Refused records of a step after landing; None clears what an earlier try left."""
        path = f"{self.errors_path(spec)}/step={step}"
        if errors is None:
            if not path_exists(self.spark, f"{path}/{LOAD_ID}={load_id}"):
                return
            kept = T.StructType([f for f in ERROR_SCHEMA.fields if f.name not in ("step", LOAD_ID)])
            errors = self.spark.createDataFrame([], kept)
        self.write_load(errors, path, load_id, by="dt")

    # -- reads -----------------------------------------------------------

    def read(self, path: str, schema: T.StructType, load_id: int | None = None) -> DataFrame:
        """Everything under ``path``, or the one load's folder without listing the others."""
        folder = path if load_id is None else f"{path}/{LOAD_ID}={load_id}"
        if not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", path).parquet(folder)

    def open_loads(self, spec: TableSpec) -> list[int]:
        """Loads whose records lie in folders of their own, those of finished folds left out."""
        return self._not_folded(spec, self._all_loads(spec))

    def _not_folded(self, spec: TableSpec, loads: list[int]) -> list[int]:
        """Those of ``loads``, in order, that no finished fold holds."""
        folds = [v for v in self._folds(spec) if loads and v >= loads[0]]
        if not folds:
            return loads
        # a fold that could not remove its folders, or a load that was repeated after it
        taken = self.spark.read.schema(T.StructType([LOAD_FIELD])).parquet(*[f"{self._marks_path(spec)}/v={v}" for v in folds])
        gone = {r[0] for r in taken.filter(F.col(LOAD_ID).isin(loads)).collect()}
        return [n for n in loads if n not in gone]

    def _landed(self, spec: TableSpec, loads: list[int]) -> DataFrame:
        """Landed records of some loads, good and bad."""
        path = self.raw_path(spec)
        schema = T.StructType([*landed_schema(spec).fields, LOAD_FIELD, T.StructField(OUTCOME, T.StringType())])
        if not loads:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{LOAD_ID}={n}" for n in loads])

    def landed(self, spec: TableSpec, load_id: int) -> DataFrame:
        """All records of a load that is not folded yet, with the reason of those that were refused."""
        return self._landed(spec, [load_id])

    def raw(self, spec: TableSpec, load_id: int | None = None) -> DataFrame:
        """Raw rows of all loads or of one; an append-only table that may repeat records.

        Beside the record and its lineage a row has ``_key`` and ``_cursor``, which filters should use: Parquet
        skips row groups by them. Folded days come first, then the loads since.
        """
        names = stored_raw_schema(spec).names
        if load_id is not None and path_exists(self.spark, f"{self.raw_path(spec)}/{LOAD_ID}={load_id}"):
            return self._landed(spec, [load_id]).filter(F.col(OUTCOME) == GOOD).select(*names)
        rows = self._landed(spec, [] if load_id is not None else self.open_loads(spec)).filter(F.col(OUTCOME) == GOOD).select(*names)
        folds = self._folds(spec)
        if folds:
            rows = self._days(spec, folds).select(*names).unionByName(rows)
        return rows if load_id is None else rows.filter(F.col(LOAD_ID) == load_id)

    def errors(self, spec: TableSpec) -> DataFrame:
        """Refused records of landing and of later steps."""
        rows = self._as_errors(self._landed(spec, self.open_loads(spec)).filter(F.col(OUTCOME) == BAD))
        later = self.read(self.errors_path(spec), ERROR_SCHEMA)
        return rows.unionByName(later.filter((F.col("step") != "parse") | F.col(LOAD_ID).isin(self._folds(spec))))

    def _all_loads(self, spec: TableSpec) -> list[int]:
        return self._loads_under(self.raw_path(spec))

    def _loads_under(self, path: str) -> list[int]:
        names = folder_names(self.spark, path)
        return sorted(int(n.removeprefix(f"{LOAD_ID}=")) for n in names if n.startswith(f"{LOAD_ID}="))

    def _as_errors(self, rows: DataFrame) -> DataFrame:
        return rows.select(
            "line", SOURCE_FILE, "reason", LOADED_AT, F.col(LOADED_AT).cast("date").alias("dt"), F.lit("parse").alias("step"), LOAD_ID
        )

    def load_errors(self, spec: TableSpec, step: str, load_id: int) -> DataFrame:
        """Refused records of one step of one load."""
        if step == "parse" and path_exists(self.spark, f"{self.raw_path(spec)}/{LOAD_ID}={load_id}"):
            return self._as_errors(self._landed(spec, [load_id]).filter(F.col(OUTCOME) == BAD))
        schema = T.StructType([f for f in ERROR_SCHEMA.fields if f.name != "step"])
        return self.read(f"{self.errors_path(spec)}/step={step}", schema, load_id)

    # -- summaries -------------------------------------------------------

    def write_summaries(self, spec: TableSpec, load_id: int) -> None:
        """Delays and keys of a load, small enough to answer for months of loads."""
        self.write_load(summaries(self.raw(spec, load_id)), f"{self.summaries_path(spec)}/loads", load_id)

    def summaries(self, spec: TableSpec) -> DataFrame:
        """Summaries of all loads, those of folded days merged."""
        path = self.summaries_path(spec)
        loads = [f"{path}/loads/{LOAD_ID}={n}" for n in self.open_loads(spec)]
        folds = [f"{path}/folds/v={v}" for v in self._folds(spec)]
        there = [p for p in (*loads, *folds) if path_exists(self.spark, p)]
        return self.spark.read.schema(SUMMARY_SCHEMA).parquet(*there) if there else self.spark.createDataFrame([], SUMMARY_SCHEMA)

    def _fold_summaries(self, spec: TableSpec, loads: list[int], version: int) -> None:
        path = self.summaries_path(spec)
        there = [p for p in (f"{path}/loads/{LOAD_ID}={n}" for n in loads) if path_exists(self.spark, p)]
        if there:
            merged = merged_summaries(self.spark.read.schema(SUMMARY_SCHEMA).parquet(*there))
            merged.coalesce(1).write.mode("overwrite").parquet(f"{path}/folds/v={version}")

    # -- days ------------------------------------------------------------

    def _marks_path(self, spec: TableSpec) -> str:
        return f"{self.days_path(spec)}/folds"

    def _folds(self, spec: TableSpec) -> list[int]:
        """Finished folds of landed loads, each by its last load."""
        return self._finished(self._marks_path(spec))

    def _finished(self, path: str) -> list[int]:
        """The versions under ``path`` whose job is done; a listing, not a job."""
        found = []
        for name in folder_names(self.spark, path):
            # Spark shows a file only once its job is done
            if any(not part.startswith(("_", ".")) for part in folder_names(self.spark, f"{path}/{name}")):
                found.append(int(name.removeprefix("v=")))
        return sorted(found)

    def _days(self, spec: TableSpec, folds: list[int]) -> DataFrame:
        """Rows of folded days; ``_day`` prunes whole folders."""
        path = f"{self.days_path(spec)}/rows"
        schema = T.StructType([*stored_raw_schema(spec).fields, T.StructField("v", T.LongType()), T.StructField(DAY, T.DateType())])
        there = [f"{path}/v={v}" for v in folds if path_exists(self.spark, f"{path}/v={v}")]
        if not there:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", path).parquet(*there)

    def fold_days(self, spec: TableSpec, before: date | str, file_bytes: int = FOLDED_FILE_BYTES) -> list[int]:
        """Moves the loads that ended before a day into a few files a day, sorted by key; which loads.

        Their refused records move to the error area. A key with much of a day spreads over several files. No task sorts
        more than about FOLDED_TASK_ROWS rows, however many there are. What is
        folded is marked last, and folders of loads go after that, so a crash loses and repeats nothing. Not to be run
        beside a load that is being repeated.
        """
        loads = self.open_loads(spec)
        landed = self._landed(spec, loads)
        good, bad = (F.count_if(F.col(OUTCOME) == o) for o in (GOOD, BAD))
        ended = landed.groupBy(LOAD_ID).agg(F.max(LOADED_AT).alias("last"), good.alias("good"), bad.alias("bad"))
        counted = ended.select(LOAD_ID, (F.col("last") >= F.lit(str(before)).cast("date")).alias("later"), "good", "bad").collect()
        later = {r[LOAD_ID] for r in counted if r.later}
        closed = [n for n in loads if n not in later]
        if closed:
            version, path = max(closed), self.days_path(spec)
            for name in folder_names(self.spark, f"{path}/rows"):
                if int(name.removeprefix("v=")) not in self._folds(spec):
                    remove_folder(self.spark, f"{path}/rows/{name}")
            landed = self._landed(spec, closed)
            rows = landed.filter(F.col(OUTCOME) == GOOD).select(*stored_raw_schema(spec).names, F.col(LOADED_AT).cast("date").alias(DAY))
            size = sum(folder_bytes(self.spark, f"{self.raw_path(spec)}/{LOAD_ID}={n}") for n in closed)
            order = [DAY, RAW_KEY, LOAD_ID, SOURCE_FILE, POSITION]
            n_good, n_bad = (sum(r[o] for r in counted if not r.later) for o in ("good", "bad"))
            tasks = max(1, -(-size // min(file_bytes, FOLDED_TASK_BYTES)), -(-n_good // FOLDED_TASK_ROWS))
            rows = rows.repartitionByRange(tasks, *order).sortWithinPartitions(DAY, RAW_KEY)
            rows.write.mode("overwrite").partitionBy(DAY).options(**bloom_options(RAW_KEY)).parquet(f"{path}/rows/v={version}")
            bad = self._as_errors(landed.filter(F.col(OUTCOME) == BAD)).drop("step", LOAD_ID)
            spread = max(1, -(-n_bad // FOLDED_TASK_ROWS))
            bad = bad.coalesce(1) if spread == 1 else bad.repartitionByRange(spread, "dt", SOURCE_FILE, "line")
            bad.write.mode("overwrite").partitionBy("dt").parquet(f"{self.errors_path(spec)}/step=parse/{LOAD_ID}={version}")
            self._fold_summaries(spec, closed, version)
            self._fold_audit(spec, closed, version)
            marks = self.spark.createDataFrame([(n,) for n in closed], T.StructType([LOAD_FIELD]))
            marks.coalesce(1).write.mode("overwrite").parquet(f"{self._marks_path(spec)}/v={version}")
        for n in [*closed, *(n for n in self._all_loads(spec) if n not in loads)]:
            remove_folder(self.spark, f"{self.raw_path(spec)}/{LOAD_ID}={n}")
            remove_folder(self.spark, f"{self.summaries_path(spec)}/loads/{LOAD_ID}={n}")
            remove_folder(self.spark, f"{self.audit_path(spec)}/{LOAD_ID}={n}")
        return closed

    def expire_days(self, spec: TableSpec, before: date | str) -> list[str]:
        """Removes folded raw rows of the days before one, whole folders without reading them; which."""
        path, gone = f"{self.days_path(spec)}/rows", []
        for version in folder_names(self.spark, path):
            for day in folder_names(self.spark, f"{path}/{version}"):
                if day.startswith(f"{DAY}=") and day.removeprefix(f"{DAY}=") < str(before)[:10]:
                    remove_folder(self.spark, f"{path}/{version}/{day}")
                    gone.append(day.removeprefix(f"{DAY}="))
        return sorted(set(gone))

    def expire_errors(self, spec: TableSpec, now: datetime | str, days: int = ERROR_DAYS) -> list[str]:
        """Removes refused records older than ``days``; those of loads not folded yet stay with them. Which days went."""
        last_kept = str(datetime.fromisoformat(str(now)).date() - timedelta(days=days))
        gone = []
        for step in folder_names(self.spark, self.errors_path(spec)):
            for load in folder_names(self.spark, f"{self.errors_path(spec)}/{step}"):
                folder = f"{self.errors_path(spec)}/{step}/{load}"
                for day in folder_names(self.spark, folder):
                    if day.startswith("dt=") and day.removeprefix("dt=") < last_kept:
                        remove_folder(self.spark, f"{folder}/{day}")
                        gone.append(day.removeprefix("dt="))
        return sorted(set(gone))

    # -- history and typed tables ----------------------------------------

    def audit(self, spec: TableSpec) -> DataFrame:
        """One row per file of each load, and one per file of each try that failed (``row_parsed`` is NULL there)."""
        path = self.audit_path(spec)
        loads = [f"{path}/{LOAD_ID}={n}" for n in self._not_folded(spec, self._loads_under(path))]
        folds = [p for p in (f"{path}_days/v={v}" for v in self._folds(spec)) if path_exists(self.spark, p)]
        rows = self.read(self.failures_path(spec), AUDIT_SCHEMA).select(*AUDIT_SCHEMA.names)
        if loads:
            rows = rows.unionByName(self.spark.read.schema(AUDIT_SCHEMA).option("basePath", path).parquet(*loads))
        return rows.unionByName(self.spark.read.schema(AUDIT_SCHEMA).parquet(*folds)) if folds else rows

    def _fold_audit(self, spec: TableSpec, loads: list[int], version: int) -> None:
        path = self.audit_path(spec)
        there = [p for p in (f"{path}/{LOAD_ID}={n}" for n in loads) if path_exists(self.spark, p)]
        if there:
            rows = self.spark.read.schema(AUDIT_SCHEMA).option("basePath", path).parquet(*there)
            rows.coalesce(1).write.mode("overwrite").parquet(f"{path}_days/v={version}")

    def write_failure(self, spec: TableSpec, load_id: int | None, rows: DataFrame) -> None:
        """History of a try that failed. It has a folder of its own, so that the repeat that succeeds does not hide it."""
        out = rows.select(*[F.col(f.name).cast(f.dataType) for f in AUDIT_SCHEMA.fields if f.name != LOAD_ID])
        out.withColumn(LOAD_ID, F.lit(load_id).cast("long")).coalesce(1).write.parquet(f"{self.failures_path(spec)}/try={uuid.uuid4().hex}")

    def base_versions(self, spec: TableSpec) -> list[int]:
        """The finished bases, by the load up to which each goes."""
        return self._finished(self.bases_path(spec))

    def base_version(self, spec: TableSpec) -> int | None:
        """The load up to which the newest finished base goes."""
        return max(self.base_versions(spec), default=None)

    def _manifest(self, spec: TableSpec, version: int) -> tuple[str, int, dict[int, int]]:
        """Name of a base, how many buckets it has, and by bucket the version whose folder holds it."""
        path = f"{self.bases_path(spec)}/v={version}"
        rows = self.spark.read.schema(MANIFEST_SCHEMA).parquet(path).collect()
        return rows[0].made, rows[0].buckets, {r.bucket: r.version for r in rows if r.bucket is not None}

    def base(self, spec: TableSpec, version: int) -> DataFrame:
        """The rows of a base with their bucket, read as a bucketed table of the session's catalog.

        Such a table is never changed: each base has one of its own, under a name nothing else has.
        """
        made, buckets, versions = self._manifest(spec, version)
        name = f"millrace_{spec.namespace}_{spec.folder}_{made}"
        if not self.spark.catalog.tableExists(name):
            folder = self.base_path(spec)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.typed_schema.fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
                f"CLUSTERED BY (`{spec.key}`) INTO {buckets} BUCKETS LOCATION '{folder}/empty'"
            )
            parts = " ".join(f"PARTITION ({BUCKET}={b}) LOCATION '{folder}/v={v}/{BUCKET}={b}'" for b, v in versions.items())
            if parts:
                self.spark.sql(f"ALTER TABLE {name} ADD {parts}")
        return self.spark.table(name)

    def changes_path(self, spec: TableSpec, base: int | None) -> str:
        """Changes lie beside those of the same base, so a read lists only what it needs."""
        return f"{self.root}/{spec.namespace}/{spec.folder}/changes/after={'start' if base is None else base}"

    def load_id(self, spec: TableSpec, source: str, batch: str) -> int:
        """The id of a source's batch: the one it had if it is repeated, else one no load of the table has.

        Streams, polls and merges by hand all ask here, so none can take another's folders.
        """
        ids = LoadIds(self.spark, f"{self.root}/state/loads/{spec.namespace}_{spec.folder}")
        return ids.take(source, batch, None if ids.started() else lambda: self._highest(spec))

    def _highest(self, spec: TableSpec) -> int | None:
        """The highest id that raw or typed data have."""
        found = [*self._all_loads(spec)[-1:], *self._folds(spec)[-1:], self.last_load(spec)]
        return max((n for n in found if n is not None), default=None)

    def write_changes(self, spec: TableSpec, changes: DataFrame, load_id: int) -> None:
        """Changes of a load; if a base already goes beyond it, they follow that base under an id of their own."""
        base = self.base_version(spec)
        if base is not None and load_id <= base:
            load_id = self.load_id(spec, "late", f"{load_id}/{base}")
        self.write_load(changes, self.changes_path(spec, base), load_id)

    def changes(self, spec: TableSpec, base: int | None) -> DataFrame:
        """Changes of the loads after ``base``."""
        rows = self.read(self.changes_path(spec, base), with_load_id(change_schema(spec)))
        return rows if base is None else rows.filter(F.col(LOAD_ID) > base)

    def last_load(self, spec: TableSpec) -> int | None:
        """The newest load of the typed table."""
        base = self.base_version(spec)
        newest = self.changes(spec, base).agg(F.max(LOAD_ID)).first()[0]
        return base if newest is None else newest

    def typed(self, spec: TableSpec, guard: bool = True, keep_tombstones: bool = False) -> DataFrame:
        """The typed table, one row per key."""
        version = self.base_version(spec)
        changes = self.changes(spec, version)
        base = None if version is None else self.base(spec, version)
        return self._merged(spec, base, changes, guard, keep_tombstones)

    def _merged(
        self, spec: TableSpec, base: DataFrame | None, changes: DataFrame, guard: bool, keep_tombstones: bool
    ) -> DataFrame:
        # The number of change rows comes from file footers and bounds the rows merged.
        bound = None if base is None else changes.count()
        if spec.changelog:
            return apply_changelog(base, changes.drop(LOAD_ID), spec, keep_tombstones, source_rows=bound, in_place=True)
        folded = fold_loads(changes, spec, guard)
        return insert_all(folded, spec) if base is None else merge_changes(base, folded, spec, guard, bound, in_place=True)

    def compact(self, spec: TableSpec, keep_tombstones: bool = False) -> int | None:
        """Writes the buckets that changed since the last base as parts of a new one; later reads start from it.

        Not to be run beside a load of the same table.
        """
        upto, version = self.last_load(spec), self.base_version(spec)
        if upto is None or upto == version:
            return upto
        changes = self.changes(spec, version)
        rows, buckets, kept = changes.count(), None, {}
        base = None if version is None else self.base(spec, version)
        if base is not None:
            _, buckets, kept = self._manifest(spec, version)
            rows += base.count()
        if buckets is None or (rows > 4 * self.bucket_rows * buckets and buckets < MOST_BUCKETS):
            buckets, kept = min(1 << (max(1, -(-rows // self.bucket_rows)) - 1).bit_length(), MOST_BUCKETS), {}
            merged = self._merged(spec, base, changes, True, keep_tombstones).repartition(buckets, spec.key)
        else:
            touched = [r[0] for r in changes.select(bucket_of(spec.key, buckets)).distinct().collect()]
            kept = {b: v for b, v in kept.items() if b not in touched}
            merged = self._merged(spec, base.filter(F.col(BUCKET).isin(touched)), changes, True, keep_tombstones)
        written = self._write_base(spec, merged, buckets, upto)
        # The manifest is written last, so an unfinished base is never read.
        made = uuid.uuid4().hex
        entries = [(upto, made, buckets, b, v) for b, v in (kept | written).items()] or [(upto, made, buckets, None, None)]
        manifest = self.spark.createDataFrame(entries, MANIFEST_SCHEMA)
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.bases_path(spec)}/v={upto}")
        return upto

    def _write_base(self, spec: TableSpec, rows: DataFrame, buckets: int, upto: int) -> dict[int, int]:
        """Writes rows by bucket under the version ``upto``, over what an unfinished try left; which buckets there are."""
        path = f"{self.base_path(spec)}/v={upto}"
        remove_folder(self.spark, path)
        name = f"millrace_{spec.namespace}_{spec.folder}_{uuid.uuid4().hex}"
        out = rows.withColumn(BUCKET, bucket_of(spec.key, buckets))
        out.write.partitionBy(BUCKET).bucketBy(buckets, spec.key).option("path", path).saveAsTable(name, format="parquet")
        # the table was only a way to write; its files stay
        self.spark.sql(f"DROP TABLE {name}")
        return {int(n.split("=")[1]): upto for n in folder_names(self.spark, path) if n.startswith(f"{BUCKET}=")}

    def prune(self, spec: TableSpec, keep: int = 2) -> list[int]:
        """Removes all but the newest ``keep`` bases and the changes they made needless.

        Keep at least two, so that a read begun before the last compaction can finish. Buckets
        that a newer base took over stay. Returns the versions removed.
        """
        if keep < 1:
            raise ValueError("the newest base must stay")
        versions = self.base_versions(spec)
        old = versions[:-keep]
        # Changes written after a base that goes, and before the first base, are in the bases that stay.
        for base in [None, *old] if old else []:
            remove_folder(self.spark, self.changes_path(spec, base))
        needed = {(v, b) for version in versions[-keep:] for b, v in self._manifest(spec, version)[2].items()}
        for version in old:
            made, _, _ = self._manifest(spec, version)
            remove_folder(self.spark, f"{self.bases_path(spec)}/v={version}")
            self.spark.sql(f"DROP TABLE IF EXISTS millrace_{spec.namespace}_{spec.folder}_{made}")
        if old:
            self._remove_unneeded(spec, needed, versions[-1])
        return old

    def _remove_unneeded(self, spec: TableSpec, needed: set[tuple[int, int]], newest: int) -> None:
        """Bucket folders up to the newest base that no base names."""
        folder = self.base_path(spec)
        for name in folder_names(self.spark, folder):
            version = int(name.removeprefix("v=")) if name.startswith("v=") else None
            if version is None or version > newest:
                continue
            held = [n for n in folder_names(self.spark, f"{folder}/{name}") if n.startswith(f"{BUCKET}=")]
            gone = [n for n in held if (version, int(n.split("=")[1])) not in needed]
            for n in gone if len(gone) < len(held) else [None]:
                remove_folder(self.spark, f"{folder}/{name}" if n is None else f"{folder}/{name}/{n}")
