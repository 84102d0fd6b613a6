"""Queries over landing: parsing, typing, pulls, routing, files and streams."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.folders import folder_names
from millrace.functions.records import parse_lines, parse_records
from millrace.functions.typed import BAD_FIELDS, apply_length, cast_field, convert_record, split_bad, typed
from millrace.operators.files import expired_files, file_day, load_errors, load_history, new_files, with_line_counts
from millrace.operators.routes import ROUTE, bin_counts, with_route
from millrace.plans import feeds
from millrace.plans.procedure import merge_cdc_batch
from millrace.plans.registry import query
from millrace.session import scratch_dir
from millrace.sources.landing import change_time_of, operation_of, to_raw
from millrace.sources.polling import read_polled
from millrace.sources.pulls import PullState, incremental_pull, next_hwm, object_pull
from millrace.sources.stage import LAYOUT_DAY, list_files, read_stage, stage_path, write_stage
from millrace.specs import ACCOUNTS, CUSTOMERS, OP_DELETE, OP_UPDATE, ORDERS, RAW_KEY, SOURCE_FILE, Field
from millrace.storage import Store
from millrace.streaming.bins import FULL, start_binning, stop_between_batches
from millrace.streaming.loader import BadRecords, LoadOptions, copy_into_raw, load_batch, parsed_records, pull_once, start_poll, start_stream

EVENT_TEXT = feeds.EVENT_TEXT_SQL


@query(
    "json_parse",
    f"""
    SELECT event_id, json_valid(line) AS is_valid,
           CASE WHEN json_valid(line) THEN CAST(json_extract(line, '$.k') AS BIGINT) END AS k
    FROM ({EVENT_TEXT})
    """,
)
def strict_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lines(feeds.event_text(spark, sf_dir))
    return parsed.select(
        "event_id",
        F.col("reason").isNull().alias("is_valid"),
        F.when(F.col("reason").isNull(), F.try_variant_get("record", "$.k", "bigint")).alias("k"),
    )


@query(
    "strip_outer_array",
    """
    SELECT event_id, 0 AS item, event_id AS n FROM events WHERE event_id % 5 <> 0
    UNION ALL
    SELECT event_id, i AS item, event_id + i AS n FROM events, (VALUES (1), (2)) AS v(i) WHERE event_id % 5 IN (2, 3, 4)
    """,
)
def outer_arrays_stripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that hold an empty array, one object, or an array of three with an odd one out."""
    n = F.col("event_id")
    one = F.concat(F.lit('{"n": '), n.cast("string"), F.lit("}"))
    three = F.format_string(' [{"n": %d}, {"n": %d},{"n": %d}, 17, null] ', n, n + 1, n + 2)
    line = F.when(n % 5 == 0, "[]").when(n % 5 == 1, one).otherwise(three)
    good, _ = parse_records(feeds.table(spark, sf_dir, "events").select(n, line.alias("value")))
    return good.select("event_id", "item", F.variant_get("record", "$.n", "bigint").alias("n"))


@query(
    "on_error_continue",
    f"""
    SELECT source_file, CASE WHEN json_valid(line) THEN 'loaded' ELSE 'malformed' END AS outcome, count(*) AS n_rows
    FROM ({EVENT_TEXT}) GROUP BY ALL
    """,
)
def bad_records_do_not_stop_a_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = parse_records(feeds.event_text(spark, sf_dir))
    outcomes = good.select(SOURCE_FILE, F.lit("loaded").alias("outcome")).unionByName(
        bad.select(SOURCE_FILE, F.col("reason").alias("outcome"))
    )
    counts = outcomes.groupBy(SOURCE_FILE, "outcome").agg(F.count("*").alias("n_rows"))
    return counts.withColumnRenamed(SOURCE_FILE, "source_file")


@query(
    "copy_into_raw",
    f"""
    SELECT source_file, source_file AS batch_id, 'UPSERT' AS operation,
           TIMESTAMP '2024-02-01' AS cdc_timestamp, TIMESTAMP '2024-02-01' AS loaded_at,
           count(*) AS n_rows, CAST(sum(CAST(json_extract(line, '$.k') AS BIGINT)) AS BIGINT) AS sum_k
    FROM ({EVENT_TEXT}) WHERE json_valid(line) GROUP BY source_file
    """,
)
def lines_copied_into_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, scratch_dir(spark, "copy_into_raw"))
    options = LoadOptions(load_ts=feeds.FIRST_LOAD)
    copy_into_raw(store, CUSTOMERS, feeds.event_text(spark, sf_dir), 0, options, feeds.FIRST_LOAD)
    return (
        store.raw(CUSTOMERS)
        .groupBy(
            F.col("_source_file").alias("source_file"),
            F.col("_batch_id").alias("batch_id"),
            F.col("_cdc_operation").alias("operation"),
            F.col("_cdc_timestamp").alias("cdc_timestamp"),
            F.col("_loaded_at").alias("loaded_at"),
        )
        .agg(F.count("*").alias("n_rows"), F.sum(F.variant_get("_raw_json", "$.k", "bigint")).alias("sum_k"))
    )


@query(
    "variant_extract",
    """
    SELECT event_id AS sequence, user_id AS id, 'User' AS first_name, event_type AS status, ts AS updated_at,
           CAST(NULL AS VARCHAR) AS phone
    FROM events
    """,
)
def paths_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.event_raw(spark, sf_dir)
    rows = typed(raw, CUSTOMERS, keep_record=True)
    sequence = F.variant_get("_raw_json", "$.sequence", "bigint").alias("sequence")
    return rows.select(sequence, "id", "first_name", "status", "updated_at", "phone")


@query(
    "varchar_limit",
    """
    SELECT doc_id, substring(text, 1, 100) AS last_name, length(text) > 100 AS is_long,
           CASE WHEN length(text) <= 100 THEN text END AS loaded,
           CASE WHEN length(text) > 100 THEN 'bad value: last_name' END AS reason
    FROM documents
    """,
)
def long_strings_cut_or_set_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text as a name: cut where that is asked for; else a long one is set aside with its reason."""
    docs = feeds.table(spark, sf_dir, "documents").select("doc_id", feeds.record(id=F.col("doc_id"), last_name=F.col("text")))
    field = CUSTOMERS.field("last_name")
    value = cast_field(F.col("record"), field)
    raw = to_raw(docs.withColumn(SOURCE_FILE, feeds.null_text()), CUSTOMERS, load_ts=feeds.FIRST_LOAD, position=feeds.position(F.col("doc_id")))
    good, bad = split_bad(typed(raw, CUSTOMERS, on_long="quarantine"))
    reason = F.concat(F.lit("bad value: "), F.array_join(BAD_FIELDS, ", "))
    outcome = good.select("id", F.col("last_name").alias("loaded"), feeds.null_text().alias("reason")).unionByName(
        bad.select("id", feeds.null_text().alias("loaded"), reason.alias("reason"))
    )
    cut = docs.select(
        "doc_id",
        apply_length(value, field, "truncate").alias("last_name"),
        (F.length(value) > field.length).alias("is_long"),
    )
    return cut.join(outcome, F.col("doc_id") == F.col("id")).drop("id")


@query(
    "decimal_cast",
    """
    SELECT o_orderkey AS id,
           CAST(CAST(sign || price || '5' AS DECIMAL(18,3)) AS DECIMAL(12,2)) AS from_number,
           CAST(CAST(sign || price || '5' AS DECIMAL(18,3)) AS DECIMAL(12,2)) AS from_text,
           CAST(round(CAST(sign || price AS DECIMAL(14,2)), 0) AS BIGINT) AS whole
    FROM (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) AS price,
                 CASE WHEN o_custkey % 2 = 0 THEN '-' ELSE '' END AS sign FROM orders)
    """,
)
def amounts_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts with a third decimal, as JSON numbers and as texts, of both signs."""
    price = F.col("o_totalprice").cast("decimal(14,2)").cast("string")
    signed = F.concat(F.when(F.col("o_custkey") % 2 == 0, "-").otherwise(""), price)
    line = F.format_string('{"n": %s5, "t": "%s5", "w": %s}', signed, signed, signed)
    good, _ = parse_records(feeds.table(spark, sf_dir, "orders").select("o_orderkey", line.alias("value")))
    record = F.col("record")
    return good.select(
        F.col("o_orderkey").alias("id"),
        cast_field(record, Field("total_amount", "decimal(12,2)", "$.n")).alias("from_number"),
        cast_field(record, Field("total_amount", "decimal(12,2)", "$.t")).alias("from_text"),
        cast_field(record, Field("whole", "bigint", "$.w")).alias("whole"),
    )


@query("date_cast", "SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS order_date FROM orders")
def dates_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    line = F.format_string('{"id": %d, "order_date": "%s"}', F.col("o_orderkey"), day)
    good, _ = parse_records(feeds.table(spark, sf_dir, "orders").select(line.alias("value")))
    record = F.col("record")
    return good.select(
        cast_field(record, ORDERS.field("id")).alias("id"),
        cast_field(record, ORDERS.field("order_date")).alias("order_date"),
    )


@query(
    "timestamp_cast",
    """
    SELECT event_id, ts AS with_offset, ts AS zulu, date_trunc('millisecond', ts) AS object_style,
           ts - INTERVAL 2 HOUR AS normalized, date_trunc('millisecond', ts) AS from_millis
    FROM events
    """,
)
def timestamps_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamp texts with an offset, with Z, with +0000, and epoch milliseconds."""
    wall = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    short = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    millis = F.unix_millis(F.concat(short, F.lit("Z")).cast("timestamp"))
    line = F.format_string('{"o": "%s+02:00", "z": "%sZ", "s": "%s+0000", "m": %d}', wall, wall, short, millis)
    good, _ = parse_records(feeds.table(spark, sf_dir, "events").select("event_id", line.alias("value")))
    record = F.col("record")
    return good.select(
        "event_id",
        cast_field(record, Field("a", "timestamp_ntz", "$.o")).alias("with_offset"),
        cast_field(record, Field("a", "timestamp_ntz", "$.z")).alias("zulu"),
        cast_field(record, Field("a", "timestamp_ntz", "$.s")).alias("object_style"),
        cast_field(record, Field("a", "timestamp_ntz", "$.o"), normalize_utc=True).alias("normalized"),
        cast_field(record, Field("a", "timestamp_ntz", "$.m", unit="millis")).alias("from_millis"),
    )


@query(
    "convert_record",
    """
    SELECT o_orderkey AS id,
           '{"id":' || o_orderkey || ',"customer_id":' || o_custkey || ',"order_date":"' || CAST(o_orderdate AS DATE)
           || '","status":"' || o_orderstatus || '","total_amount":' || CAST(o_totalprice AS DECIMAL(12,2))
           || ',"currency":"GBP","created_at":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f')
           || '","updated_at":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || '"}' AS value
    FROM orders
    """,
)
def records_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_record(feeds.order_raw(spark, sf_dir), ORDERS)


@query(
    "route_by_op",
    """
    SELECT CASE WHEN event_id % 10 = 0 THEN 'DELETE' WHEN event_id % 10 <= 3 THEN 'UPDATE' ELSE 'unmatched' END AS route,
           count(*) AS n_rows, min(event_id) AS first_id, max(event_id) AS last_id
    FROM events GROUP BY 1
    """,
)
def records_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates and deletes have a route of their own; inserts are left unmatched."""
    events = feeds.table(spark, sf_dir, "events").withColumn("op", feeds.event_operation())
    routed = with_route(events, "op", [OP_UPDATE, OP_DELETE])
    return routed.groupBy(F.col(ROUTE).alias("route")).agg(
        F.count("*").alias("n_rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


# Bounds of a bin, and what a micro-batch may take beyond its age.
BIN_RECORDS, BIN_AGE_S, BIN_SLACK_S = 500, 2, 120
# Records of a staged file, about, and files a micro-batch takes: it so lasts seconds, however many records wait.
BIN_FILE_RECORDS, BIN_BATCH_FILES = 125_000, 16


def staged_for_bins(events: DataFrame, wanted: int) -> DataFrame:
    """``event_type, value`` of the events, dealt over files of about BIN_FILE_RECORDS.

    A type has enough records in each of its files to fill bins, so none waits half full for a later file: a frequent one
    is in all files, any other in one.
    """
    files = max(4, -(-wanted // BIN_FILE_RECORDS))
    counts = events.groupBy("event_type").agg((F.count("*") >= 4 * BIN_RECORDS * files).alias("frequent"))
    counts = F.broadcast(counts.withColumnRenamed("event_type", "_type"))
    dealt = events.join(counts, F.col("event_type").eqNullSafe(F.col("_type")), "left")
    file = F.pmod(F.when(F.col("frequent"), F.xxhash64("event_id")).otherwise(F.xxhash64("event_type")), F.lit(files)).cast("int")
    lines = F.to_json(F.struct("event_id", "event_type")).alias("value")
    return dealt.repartitionById(files, file).select("event_type", lines)


@query(
    "bin_records",
    """
    SELECT event_type, count(*) AS n_records, CAST(sum(event_id) AS BIGINT) AS sum_id, count(*) // 500 AS n_full,
           CAST(0 AS BIGINT) AS n_oversized, CAST(0 AS BIGINT) AS n_overaged, TRUE AS files_agree
    FROM events GROUP BY 1
    """,
)
def records_binned_by_size_and_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events streamed into bins by type that close when full or old; their files hold every event once."""
    root = scratch_dir(spark, "bin_records")
    events = feeds.table(spark, sf_dir, "events")
    wanted = events.count()
    staged_for_bins(events, wanted).write.json(f"{root}/in")
    lines = spark.readStream.schema("event_type string, value string").option("maxFilesPerTrigger", BIN_BATCH_FILES).json(f"{root}/in")
    stream = start_binning(spark, lines, f"{root}/out", f"{root}/checkpoint", ["event_type"], BIN_RECORDS, BIN_AGE_S)
    try:
        # the last bins are not full and close by their age, which no source end brings about
        done, until = -1, time.time() + BIN_SLACK_S
        while done < wanted and time.time() < until:
            if stream.exception():
                raise stream.exception()
            time.sleep(0.5)
            before, done = done, binned(spark, f"{root}/out/bins")
            if done > before:  # only a stream that stands still is given up
                until = time.time() + BIN_SLACK_S
    finally:
        stop_between_batches(stream, BIN_SLACK_S)
    made = spark.read.parquet(f"{root}/out/bins").select("event_type", "lane", "number", "opened", "closed", "reason", "n_records")
    files = spark.read.option("basePath", f"{root}/out/files").text(f"{root}/out/files")
    per_file = files.groupBy("event_type", F.col("_metadata.file_path")).agg(F.count("*").alias("n"), F.sum(F.get_json_object("value", "$.event_id").cast("long")).alias("ids"))
    per_type = per_file.groupBy("event_type").agg(F.sum("n").alias("n_records"), F.sum("ids").alias("sum_id"), F.count("*").alias("n_files"), F.count_if(F.col("n") > BIN_RECORDS).alias("n_oversized"))
    aged = F.col("closed") - F.col("opened") > 1000 * (BIN_AGE_S + BIN_SLACK_S)
    told = made.groupBy("event_type").agg(F.count("*").alias("n_bins"), F.count_if(F.col("reason") == FULL).alias("n_full"), F.count_if(aged).alias("n_overaged"))
    agree = (F.col("n_files") == F.col("n_bins")).alias("files_agree")
    return per_type.join(told, "event_type").select("event_type", "n_records", "sum_id", "n_full", "n_oversized", "n_overaged", agree)


def binned(spark: SparkSession, path: str) -> int:
    """How many records are in closed bins."""
    if not any(n.startswith("batch=") for n in folder_names(spark, path)):
        return 0
    rows = spark.read.schema("n_records int, batch int").parquet(path)
    return rows.agg(F.sum("n_records")).first()[0] or 0


@query(
    "bin_counts",
    """
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bin_start, count(*) AS n_records FROM events GROUP BY 1
    """,
)
def records_counted_by_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_counts(feeds.table(spark, sf_dir, "events"), "ts", "5 minutes")


@query(
    "write_stage",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS folder, count(*) AS n_records,
           CAST(sum(event_id) AS BIGINT) AS sum_id, CAST(0 AS BIGINT) AS n_oversized
    FROM events GROUP BY 1
    """,
)
def events_staged_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written to dated folders in files of at most 500 records and read back."""
    root = scratch_dir(spark, "write_stage")
    events = feeds.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("ts").alias("day"))
    path = write_stage(events, root, "salesforce", "accounts", "day", LAYOUT_DAY, max_records=500)
    lines = spark.read.option("recursiveFileLookup", True).text(path).select("value", F.col("_metadata.file_path").alias("file"))
    good, _ = parse_records(lines)
    per_file = good.groupBy("file").agg(
        F.count("*").alias("n"), F.sum(F.variant_get("record", "$.id", "bigint")).alias("ids")
    )
    folder = F.regexp_extract("file", r"dt=(\d{4}-\d{2}-\d{2})", 1).alias("folder")
    return per_file.groupBy(folder).agg(
        F.sum("n").alias("n_records"), F.sum("ids").alias("sum_id"), F.count_if(F.col("n") > 500).alias("n_oversized")
    )


@query(
    "incremental_pull",
    """
    SELECT event_id, user_id AS id, event_type AS status, ts AS updated_at
    FROM events WHERE ts > TIMESTAMP '2024-01-15 06:30:00'
    """,
)
def rows_past_the_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    hwm = dt.datetime(2024, 1, 15, 12, 30)
    fresh = incremental_pull(feeds.table(spark, sf_dir, "events"), "ts", hwm, dt.timedelta(hours=6))
    return fresh.select(
        "event_id", F.col("user_id").alias("id"), F.col("event_type").alias("status"), F.col("ts").alias("updated_at")
    )


@query(
    "object_pull",
    """
    WITH t AS (
      SELECT lpad(CAST(s_suppkey AS VARCHAR), 18, '0') AS sf_id, s_name AS name,
             TIMESTAMP '2024-01-01' + to_days(CAST(s_suppkey % 30 AS INTEGER)) AS last_modified_date, FALSE AS is_deleted
      FROM supplier
    ),
    s AS (
      SELECT lpad(CAST(c_custkey AS VARCHAR), 18, '0') AS sf_id, c_name AS name, c_custkey % 9 = 0 AS is_deleted,
             TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 45 AS INTEGER)) AS last_modified_date
      FROM customer
    ),
    n AS (SELECT * FROM s WHERE last_modified_date > (SELECT max(last_modified_date) FROM t))
    SELECT coalesce(t.sf_id, n.sf_id) AS sf_id, coalesce(n.name, t.name) AS name,
           coalesce(n.last_modified_date, t.last_modified_date) AS last_modified_date,
           coalesce(n.is_deleted, t.is_deleted) AS is_deleted,
           CASE WHEN t.sf_id IS NULL THEN TIMESTAMP '2024-01-05' ELSE TIMESTAMP '2024-01-01' END AS created_date,
           (t.sf_id IS NOT NULL)::INT + (n.sf_id IS NOT NULL)::INT AS n_pulled
    FROM t FULL OUTER JOIN n ON t.sf_id = n.sf_id
    """,
)
def objects_pulled_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account objects polled by their age field as a stream; the second pull goes on where the first one stopped."""
    store, path = Store(spark, scratch_dir(spark, "object_pull")), scratch_dir(spark, "objects")
    options = LoadOptions(load_ts=feeds.FIRST_LOAD)
    for objects in (feeds.supplier_objects(spark, sf_dir), feeds.customer_objects(spark, sf_dir)):
        fields = [f for f in ACCOUNTS.fields if f.path]
        plain = objects.select(*[F.variant_get("_raw_json", f.path, f.type).alias(f.path.removeprefix("$.")) for f in fields])
        plain.write.mode("append").parquet(path)
        start_poll(store, ACCOUNTS, path, "LastModifiedDate", {"availableNow": True}, options).awaitTermination()
    pulled = store.raw(ACCOUNTS).groupBy(F.col(RAW_KEY).alias("sf_id")).agg(F.count("*").cast("int").alias("n_pulled"))
    columns = ["sf_id", "name", "last_modified_date", "is_deleted", "created_date", "n_pulled"]
    return store.typed(ACCOUNTS).join(pulled, "sf_id").select(*columns)


@query(
    "objects_past_a_mark",
    """
    SELECT lpad(CAST(c_custkey AS VARCHAR), 18, '0') AS sf_id, c_name AS name,
           TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 45 AS INTEGER)) AS last_modified_date
    FROM customer
    WHERE TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 45 AS INTEGER)) > TIMESTAMP '2024-01-20'
    """,
)
def objects_past_the_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.customer_objects(spark, sf_dir)
    fresh = object_pull(raw, ACCOUNTS.field(ACCOUNTS.cursor), dt.datetime(2024, 1, 20))
    return typed(fresh, ACCOUNTS).select("sf_id", "name", "last_modified_date")


# Three polls: the first half, what came after it, and all again with a new checkpoint.
POLL_ROUNDS_SQL = """
  SELECT 1 AS round, * FROM events WHERE ts < TIMESTAMP '2024-01-16'
  UNION ALL
  SELECT 2, * FROM events WHERE ts >= TIMESTAMP '2024-01-16'
  UNION ALL
  SELECT 3, * FROM events
"""


@query(
    "hwm_advance",
    f"""
    SELECT 'ts' AS mark, round, count(*) AS n_rows, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS hwm
    FROM ({POLL_ROUNDS_SQL}) GROUP BY round
    UNION ALL
    SELECT 'event_id', round, count(*), CAST(max(event_id) AS VARCHAR) FROM ({POLL_ROUNDS_SQL}) GROUP BY round
    """,
)
def marks_move_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A growing table polled as a stream by a time and by a number; the marks are the stream's offsets."""
    path, out = scratch_dir(spark, "polled"), scratch_dir(spark, "hwm_advance")
    events = feeds.table(spark, sf_dir, "events")
    first = F.col("ts") < feeds.at("2024-01-16")
    for number, new in ((1, events.filter(first)), (2, events.filter(~first)), (3, events.limit(0))):
        new.write.mode("append").parquet(path)
        for mark in ("ts", "event_id"):

            def body(batch: DataFrame, batch_id: int, folder: str = f"{out}/mark={mark}/round={number}") -> None:
                batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

            checkpoint = f"{out}-checkpoints/{mark}/{'again' if number == 3 else 'first'}"
            polled = read_polled(spark, path, mark).writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
            polled.trigger(availableNow=True).start().awaitTermination()
    top = F.when(F.col("mark") == "ts", F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).otherwise(F.max("event_id").cast("string"))
    return spark.read.parquet(out).groupBy("mark", "round").agg(F.count("*").alias("n_rows"), top.alias("hwm"))


@query(
    "stored_marks",
    """
    SELECT 1 AS round, count(*) AS n_rows, max(ts) AS hwm FROM events WHERE ts < TIMESTAMP '2024-01-16'
    UNION ALL
    SELECT 2 AS round, count(*) AS n_rows, max(ts) AS hwm FROM events WHERE ts >= TIMESTAMP '2024-01-16'
    UNION ALL
    SELECT 3 AS round, count(*) AS n_rows, max(ts) AS hwm FROM events
    """,
)
def mark_moves_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three pulls of a source of any format: the first half, the rest after the stored mark, and all again after a reset."""
    state = PullState(spark, scratch_dir(spark, "stored_marks"))
    events = feeds.table(spark, sf_dir, "events")
    rounds = []
    for number, source in enumerate([events.filter(F.col("ts") < feeds.at("2024-01-16")), events, events], start=1):
        if number == 3:
            state.reset("events")
        pulled = incremental_pull(source, "ts", state.get("events")["hwm"])
        state.advance("events", next_hwm(pulled, "ts"), str(number))
        rounds.append(pulled.agg(F.lit(number).alias("round"), F.count("*").alias("n_rows"), F.max("ts").alias("hwm")))
    return rounds[0].unionByName(rounds[1]).unionByName(rounds[2])


@query(
    "changelog_scan",
    """
    SELECT event_id, user_id AS id,
           CASE WHEN event_id % 23 = 0 THEN NULL
                WHEN event_id % 10 = 0 THEN 'DELETE' WHEN event_id % 10 <= 3 THEN 'UPDATE' ELSE 'INSERT' END AS operation,
           CASE WHEN event_id % 17 <> 0 THEN ts END AS cdc_timestamp,
           CASE WHEN event_id % 23 = 0 THEN 'unknown operation' WHEN event_id % 17 = 0 THEN 'no change time' END AS reason
    FROM events
    """,
)
def change_events_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of a log; one without a known operation or a time to order it by is refused."""
    number = F.col("event_id")
    events = feeds.table(spark, sf_dir, "events").select(
        number,
        F.col("user_id").alias("id"),
        F.when(number % 23 == 0, "truncate").otherwise(F.lower(feeds.event_operation())).alias("op"),
        F.when(number % 17 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).otherwise(
            F.when(number % 34 == 0, "at noon")
        ).alias("ts"),
    )
    lines = events.select(F.to_json(F.struct("op", "ts", "id", "event_id"), {"ignoreNullFields": "false"}).alias("value"))
    record = F.col("record")
    return parsed_records(lines, CUSTOMERS.as_changelog()).select(
        F.variant_get(record, "$.event_id", "bigint").alias("event_id"),
        F.variant_get(record, "$.id", "bigint").alias("id"),
        operation_of(record).alias("operation"),
        change_time_of(record).alias("cdc_timestamp"),
        "reason",
    )


# -- files --------------------------------------------------------------------

# Event types whose files arrive when the first load is over.
LATE_TYPES = ("error", "view")


def stage_event_texts(spark: SparkSession, sf_dir: str, root: str, late: bool) -> None:
    """The events' texts as staged lines, a folder a day and a file each event type, with an empty array for each day."""
    path = stage_path(root, CUSTOMERS.namespace, CUSTOMERS.name)
    events = feeds.table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    day = {c: F.date_format("ts", p) for c, p in (("y", "yyyy"), ("m", "MM"), ("d", "dd"))}
    kind = F.col("event_type").isin(*LATE_TYPES)
    lines = feeds.event_text(spark, sf_dir).join(events.filter(kind if late else ~kind), "event_id")
    out = lines.withColumns(day).select("value", "y", "m", "d", F.col("event_type").alias("kind"))
    if not late:
        none = events.withColumns(day).select(F.lit("[]").alias("value"), "y", "m", "d", F.lit("none").alias("kind"))
        out = out.unionByName(none.distinct())
    # one folder is one file, since all its lines are in one partition
    out.repartition("y", "m", "d", "kind").write.mode("append").partitionBy("y", "m", "d", "kind").text(path)


def audited_store(spark: SparkSession, sf_dir: str, label: str) -> tuple[Store, str]:
    """A store that has loaded the first files in several micro-batches; the late files are staged after that."""
    root = scratch_dir(spark, label)
    store = Store(spark, root)
    stage_event_texts(spark, sf_dir, root, late=False)
    options = LoadOptions(merge=False, load_ts=feeds.FIRST_LOAD)
    start_stream(store, root, CUSTOMERS, {"availableNow": True}, options, maxFilesPerTrigger=64).awaitTermination()
    stage_event_texts(spark, sf_dir, root, late=True)
    return store, root


def stop_at_late_files(spark: SparkSession, store: Store, root: str) -> None:
    """A load of the late files that stops at its first bad record; the history has a row for each of them then."""
    late = read_stage(spark, root, CUSTOMERS.namespace, CUSTOMERS.name).filter(F.col(SOURCE_FILE).rlike(f"kind=({'|'.join(LATE_TYPES)})/"))
    files = [r[0] for r in late.select(SOURCE_FILE).distinct().collect()]
    options = LoadOptions(on_error="abort", merge=False, load_ts=feeds.SECOND_LOAD)
    try:
        load_batch(store, CUSTOMERS, late, 1000, options, files)
    except BadRecords:
        return
    raise AssertionError("no late file has a bad record")


def file_label(file: str = "file") -> Column:
    """Day and event type of a staged file, which its folders name."""
    parts = [F.regexp_extract(file, rf"/{p}=(\w+)/", 1) for p in ("y", "m", "d", "kind")]
    return F.concat_ws("/", *parts).alias("file")


def staged_files(spark: SparkSession, root: str) -> DataFrame:
    files = list_files(spark, stage_path(root, CUSTOMERS.namespace, CUSTOMERS.name))
    return files.withColumn("dt", file_day(F.col("file")))


# What the first load's files hold; days have an empty one besides.
EVENT_AUDIT_SQL = f"""
  SELECT strftime(ts, '%Y/%m/%d/') || event_type AS file, count(*) FILTER (WHERE json_valid(line)) AS row_count,
         count(*) FILTER (WHERE NOT json_valid(line)) AS error_count
  FROM events JOIN ({EVENT_TEXT}) USING (event_id) WHERE event_type NOT IN ('error', 'view') GROUP BY 1
  UNION ALL
  SELECT DISTINCT strftime(ts, '%Y/%m/%d/') || 'none', 0, 0 FROM events
"""


@query(
    "load_once",
    """
    SELECT strftime(ts, '%Y/%m/%d/') || event_type || '.json' AS file, count(*) AS n_rows
    FROM events WHERE event_type IN ('error', 'view') GROUP BY 1
    """,
)
def files_not_loaded_yet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged files beside the load history, with their lines: files without records were loaded, files of a stopped load were not."""
    store, root = audited_store(spark, sf_dir, "load_once")
    stop_at_late_files(spark, store, root)
    waiting = new_files(staged_files(spark, root), store.audit(CUSTOMERS))
    counted = with_line_counts(waiting, read_stage(spark, root, CUSTOMERS.namespace, CUSTOMERS.name))
    return counted.select(F.concat(file_label(), F.lit(".json")).alias("file"), "n_rows")


@query(
    "retention_expired",
    """
    SELECT DISTINCT strftime(ts, '%Y/%m/%d/') || kind AS file
    FROM (SELECT ts, event_type AS kind FROM events WHERE event_type NOT IN ('error', 'view')
          UNION ALL SELECT ts, 'none' FROM events)
    WHERE CAST(ts AS DATE) < DATE '2024-01-28' - 3
    """,
)
def files_past_their_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old files the history has; those that still wait to be loaded are kept."""
    store, root = audited_store(spark, sf_dir, "retention_expired")
    return expired_files(staged_files(spark, root), store.audit(CUSTOMERS), "2024-01-28 09:00:00").select(file_label())


@query(
    "copy_history",
    f"""
    SELECT file, row_count, error_count, TIMESTAMP '2024-02-01' AS last_load_time,
           CASE WHEN row_count > 0 THEN 'Partially loaded' ELSE 'Load failed' END AS status
    FROM ({EVENT_AUDIT_SQL}) WHERE error_count > 0
    """,
)
def loads_with_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = audited_store(spark, sf_dir, "copy_history")
    history = load_history(store.audit(CUSTOMERS), CUSTOMERS.raw_name, "2024-01-20 00:00:00", only_problems=True)
    return history.select(file_label(), "row_count", "error_count", "last_load_time", "status")


@query(
    "load_errors",
    f"""
    (SELECT strftime(ts, '%Y/%m/%d/') || event_type AS file, 'Load failed' AS status, CAST(NULL AS BIGINT) AS error_count,
            'malformed' AS reason, TIMESTAMP '2024-02-02' AS start_time
     FROM events WHERE event_type IN ('error', 'view') GROUP BY 1
     UNION ALL
     SELECT file, CASE WHEN row_count > 0 THEN 'Partially loaded' ELSE 'Load failed' END, error_count, 'malformed',
            TIMESTAMP '2024-02-01'
     FROM ({EVENT_AUDIT_SQL}) WHERE error_count > 0)
    ORDER BY start_time DESC, file LIMIT 20
    """,
)
def newest_failed_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that stopped at its first bad record, and before it one that went on; files of both, newest first."""
    store, root = audited_store(spark, sf_dir, "load_errors")
    stop_at_late_files(spark, store, root)
    reason = F.regexp_extract("error_message", r"(\w+)$", 1).alias("reason")
    return load_errors(store.audit(CUSTOMERS), "dev").select(file_label(), "status", "error_count", reason, "start_time")


# -- whole loads ---------------------------------------------------------------


def stage_events(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Events written as staged customer records, a folder a day."""
    events = feeds.table(spark, sf_dir, "events")
    records = events.select(
        F.col("user_id").alias("id"),
        F.lit("User").alias("first_name"),
        F.col("user_id").cast("string").alias("last_name"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
        F.col("event_id").alias("sequence"),
    )
    write_stage(records, root, CUSTOMERS.namespace, CUSTOMERS.name, "updated_at")


@query(
    "stream_copy",
    """
    SELECT strftime(ts, '%Y/%m/%d') AS folder, 'Loaded' AS status, count(*) AS row_count,
           CAST(0 AS BIGINT) AS error_count, CAST(sum(event_id) AS BIGINT) AS sum_sequence
    FROM events GROUP BY 1
    """,
)
def staged_files_streamed_into_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stream_copy")
    stage_events(spark, sf_dir, root)
    store = Store(spark, root)
    stream = start_stream(
        store, root, CUSTOMERS, {"availableNow": True}, LoadOptions(merge=False, load_ts=feeds.FIRST_LOAD), maxFilesPerTrigger=16
    )
    stream.awaitTermination()
    raw = store.raw(CUSTOMERS)
    sums = raw.groupBy(F.col(SOURCE_FILE).alias("file")).agg(
        F.sum(F.variant_get("_raw_json", "$.sequence", "bigint")).alias("sequence")
    )
    folder = F.concat_ws(
        "/", *[F.regexp_extract("file", rf"/{part}=(\d+)/", 1) for part in ("y", "m", "d")]
    )
    return (
        store.audit(CUSTOMERS)
        .join(sums, "file")
        .groupBy(folder.alias("folder"), "status")
        .agg(
            F.sum("row_count").alias("row_count"),
            F.sum("error_count").alias("error_count"),
            F.sum("sequence").alias("sum_sequence"),
        )
    )


@query(
    "stream_merge",
    """
    SELECT user_id AS id, 'User' AS first_name, CAST(user_id AS VARCHAR) AS last_name, event_type AS status,
           ts AS updated_at, FALSE AS is_deleted, 'UPSERT' AS operation
    FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def staged_files_streamed_into_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several micro-batches merged in whatever order the files arrive, with one compaction."""
    root = scratch_dir(spark, "stream_merge")
    stage_events(spark, sf_dir, root)
    store = Store(spark, root)
    options = LoadOptions(load_ts=feeds.FIRST_LOAD, compact_every=2)
    start_stream(store, root, CUSTOMERS, {"availableNow": True}, options, maxFilesPerTrigger=12).awaitTermination()
    return store.typed(CUSTOMERS).select(
        "id", "first_name", "last_name", "status", "updated_at", "is_deleted", F.col("_cdc_operation").alias("operation")
    )


@query(
    "procedure_dispatch",
    """
    WITH r AS (
      SELECT count(DISTINCT user_id) AS n FROM events
    )
    SELECT 1 AS call, 'OK: merged batch all for table customers' AS answer, n AS n_rows FROM r
    UNION ALL SELECT 2, 'OK: merged batch all for table customers', n FROM r
    UNION ALL SELECT 3, 'ERROR: unknown table invoices', n FROM r
    """,
)
def procedure_called(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay of all raw rows, the same again, and a table nobody knows."""
    store = Store(spark, scratch_dir(spark, "procedure_dispatch"))
    store.write_landed(feeds.event_raw(spark, sf_dir), CUSTOMERS, 0)
    options = LoadOptions(load_ts=feeds.FIRST_LOAD)
    calls = []
    for number, name in enumerate(["customers", "customers", "invoices"], start=1):
        answer = merge_cdc_batch(store, name, None, options)
        count = store.typed(CUSTOMERS).agg(F.count("*").alias("n_rows"))
        calls.append(count.select(F.lit(number).alias("call"), F.lit(answer).alias("answer"), "n_rows"))
    return calls[0].unionByName(calls[1]).unionByName(calls[2])


@query(
    "pull_and_merge",
    """
    SELECT user_id AS id, event_type AS status, max(ts) OVER (PARTITION BY user_id) AS updated_at,
           count(*) OVER (PARTITION BY user_id) AS n_polled
    FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def source_table_polled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source polled twice, the second time only past the stored mark; every row lands once."""
    store = Store(spark, scratch_dir(spark, "pull_and_merge"))
    events = feeds.record_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
    )
    options = LoadOptions(load_ts=feeds.FIRST_LOAD)
    pull_once(store, CUSTOMERS, events.filter(F.col("updated_at") < feeds.at("2024-01-16")), "updated_at", None, options)
    pull_once(store, CUSTOMERS, events, "updated_at", None, options)
    polled = typed(store.raw(CUSTOMERS).drop("_load_id"), CUSTOMERS).groupBy("id").agg(F.count("*").alias("n_polled"))
    return store.typed(CUSTOMERS).join(polled, "id").select("id", "status", "updated_at", "n_polled")
