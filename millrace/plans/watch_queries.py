"""Queries over quality and monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from millrace.functions.records import parse_records
from millrace.functions.typed import typed
from millrace.operators import checks, sketches, watch
from millrace.operators.merge import merge_upsert
from millrace.plans import feeds
from millrace.plans.registry import query
from millrace.session import scratch_dir
from millrace.specs import ACCOUNTS, CUSTOMERS, LOADED_AT, SOURCE_FILE, Field
from millrace.storage import Store

LOADED_AT_SQL = "date_trunc('minute', ts) + INTERVAL 65 SECOND"


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four raw tables as their feeds fill them."""
    return {
        "accounts_raw": feeds.supplier_objects(spark, sf_dir),
        "contacts_raw": feeds.customer_contacts(spark, sf_dir),
        "customers_raw": feeds.event_raw(spark, sf_dir),
        "orders_raw": feeds.order_raw(spark, sf_dir),
    }


@query(
    "raw_counts",
    """
    SELECT 'accounts_raw' AS table_name, count(*) AS n_rows FROM supplier
    UNION ALL SELECT 'contacts_raw', count(*) FROM customer
    UNION ALL SELECT 'customers_raw', count(*) FROM events
    UNION ALL SELECT 'orders_raw', count(*) FROM orders
    """,
)
def rows_per_raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watch.row_counts(raw_tables(spark, sf_dir))


@query(
    "freshness_report",
    f"""
    SELECT 'accounts_raw' AS table_name, count(*) AS n_rows, TIMESTAMP '2024-02-01' AS last_loaded_at FROM supplier
    UNION ALL SELECT 'contacts_raw', count(*), TIMESTAMP '2024-02-01' FROM customer
    UNION ALL SELECT 'customers_raw', count(*), max({LOADED_AT_SQL}) FROM events
    UNION ALL SELECT 'orders_raw', count(*), TIMESTAMP '2024-02-01' FROM orders
    """,
)
def freshness_of_raw_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watch.freshness(raw_tables(spark, sf_dir))


@query(
    "stale_feeds",
    f"""
    SELECT event_type AS feed, count(*) AS n_rows, max({LOADED_AT_SQL}) AS last_loaded_at,
           max({LOADED_AT_SQL}) < TIMESTAMP '2024-01-31 02:00:00' - INTERVAL 2 HOUR AS is_stale
    FROM events GROUP BY 1
    """,
)
def silent_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.event_raw(spark, sf_dir).withColumn("feed", F.variant_get("_raw_json", "$.status", "string"))
    return watch.stale_feeds(watch.freshness_by(raw, "feed"), "2024-01-31 02:00:00")


@query(
    "landed_last_hour",
    f"""
    SELECT count(*) AS n_rows, min(loaded_at) AS first_loaded_at, max(loaded_at) AS last_loaded_at
    FROM (SELECT {LOADED_AT_SQL} AS loaded_at FROM events) WHERE loaded_at > TIMESTAMP '2024-01-15 11:00:00'
    """,
)
def rows_landed_lately(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watch.landed_since(feeds.event_raw(spark, sf_dir), "2024-01-15 12:00:00", 1)


@query(
    "ops_by_type",
    """
    SELECT CASE WHEN event_id % 10 = 0 THEN 'DELETE' WHEN event_id % 10 <= 3 THEN 'UPDATE' ELSE 'INSERT' END AS operation,
           count(*) AS n_rows
    FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 24 HOUR GROUP BY 1
    """,
)
def operations_of_the_last_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = watch.ops_by_type(feeds.event_changes(spark, sf_dir), "2024-01-15 12:00:00", 24, "_cdc_timestamp")
    return counts.withColumnRenamed("_cdc_operation", "operation")


@query(
    "uniqueness_check",
    """
    WITH n AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
    SELECT 'raw' AS layer, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, count(*) FILTER (WHERE n > 1) AS n_repeated,
           sum(n) = count(*) AS is_unique FROM n
    UNION ALL
    SELECT 'typed', count(*), count(*), CAST(0 AS BIGINT), TRUE FROM n
    """,
)
def keys_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(feeds.event_raw(spark, sf_dir), CUSTOMERS)
    table = merge_upsert(None, rows, CUSTOMERS, load_ts=feeds.FIRST_LOAD)
    return (
        checks.uniqueness(rows, "id")
        .withColumn("layer", F.lit("raw"))
        .unionByName(checks.uniqueness(table, "id").withColumn("layer", F.lit("typed")))
    )


@query("repeated_keys", "SELECT user_id AS id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 1")
def keys_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.repeated_keys(typed(feeds.event_raw(spark, sf_dir), CUSTOMERS), "id")


def wanted_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))


def landed_events(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """The event feed as a stored raw table whose days are folded: by day, sorted by key."""
    store = Store(spark, scratch_dir(spark, label))
    store.write_landed(feeds.event_raw(spark, sf_dir), CUSTOMERS, 0)
    store.fold_days(CUSTOMERS, "2024-03-01")
    return store.raw(CUSTOMERS)


def summarised_loads(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Summaries of the event feed in three loads, those of the first two merged by day."""
    store, raw = Store(spark, scratch_dir(spark, label)), feeds.event_raw(spark, sf_dir)
    marks = [feeds.at(m) for m in ("2024-01-11", "2024-01-21")]
    loaded = F.col(LOADED_AT)
    for n, part in enumerate((loaded < marks[0], (loaded >= marks[0]) & (loaded < marks[1]), loaded >= marks[1])):
        store.write_landed(raw.filter(part), CUSTOMERS, n)
        store.write_summaries(CUSTOMERS, n)
    store.fold_days(CUSTOMERS, "2024-01-21")
    return store.summaries(CUSTOMERS)


def seen_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.event_raw(spark, sf_dir)
    return raw.select(checks.raw_key(CUSTOMERS).alias("id"))


@query("distinct_arrived", "SELECT count(DISTINCT user_id) AS n_arrived FROM events WHERE user_id IN (SELECT c_custkey FROM customer)")
def customers_arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted from the bitmaps of three loads, two of them folded."""
    return sketches.arrived_by_bitmap(wanted_customers(spark, sf_dir), summarised_loads(spark, sf_dir, "distinct_arrived"), "id")


@query("missing_ids", "SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def customers_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.missing_by_bitmap(wanted_customers(spark, sf_dir), summarised_loads(spark, sf_dir, "missing_ids"), "id")


@query("missing_rows", "SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def customers_without_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the raw rows themselves, for keys of any type."""
    return checks.missing_ids(wanted_customers(spark, sf_dir), seen_customers(spark, sf_dir), "id")


@query("arrived_rows", "SELECT count(DISTINCT user_id) AS n_arrived FROM events WHERE user_id IN (SELECT c_custkey FROM customer)")
def customers_with_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.arrived(wanted_customers(spark, sf_dir), seen_customers(spark, sf_dir), "id")


@query(
    "completeness_ratio",
    """
    SELECT count(*) AS n_expected, count(*) FILTER (WHERE seen) AS n_arrived,
           count(*) FILTER (WHERE seen) / count(*) AS ratio,
           count(*) FILTER (WHERE seen) >= count(*) * 0.95 AS is_complete
    FROM (SELECT c_custkey IN (SELECT user_id FROM events) AS seen FROM customer)
    """,
)
def share_arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.completeness(wanted_customers(spark, sf_dir), seen_customers(spark, sf_dir), "id")


@query(
    "fk_orphans",
    """
    SELECT l_orderkey + 5000 AS order_id, l_linenumber AS line, l_partkey AS part
    FROM lineitem WHERE l_orderkey + 5000 NOT IN (SELECT o_orderkey FROM orders)
    """,
)
def lines_without_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") + feeds.LINE_SHIFT).alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"),
    )
    return checks.orphans(lines, feeds.table(spark, sf_dir, "orders"), "order_id", "o_orderkey")


@query(
    "raw_point_lookup",
    """
    SELECT user_id AS id, event_id AS sequence, event_type AS status FROM events WHERE user_id = 7
    """,
)
def raw_rows_of_one_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checks.raw_point_lookup(landed_events(spark, sf_dir, "raw_point_lookup"), CUSTOMERS, 7)
    return raw_summary(found)


@query(
    "raw_in_list",
    """
    SELECT user_id AS id, event_id AS sequence, event_type AS status FROM events WHERE user_id IN (3, 5, 8, 13, 21)
    """,
)
def raw_rows_of_some_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checks.raw_in_list(landed_events(spark, sf_dir, "raw_in_list"), CUSTOMERS, [3, 5, 8, 13, 21])
    return raw_summary(found)


@query(
    "raw_in_table",
    """
    SELECT user_id AS id, event_id AS sequence, event_type AS status FROM events
    WHERE user_id IN (SELECT s_suppkey FROM supplier)
    """,
)
def raw_rows_of_listed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = feeds.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return raw_summary(checks.raw_in_list(landed_events(spark, sf_dir, "raw_in_table"), CUSTOMERS, keys))


def raw_summary(raw: DataFrame) -> DataFrame:
    return raw.select(
        checks.raw_key(CUSTOMERS).alias("id"),
        F.variant_get("_raw_json", "$.sequence", "bigint").alias("sequence"),
        F.variant_get("_raw_json", "$.status", "string").alias("status"),
    )


@query(
    "source_file_match",
    """
    SELECT strftime(ts, '%Y/%m/%d') AS day, count(*) AS n_rows FROM events
    WHERE 'staged/postgres_cdc/customers/' || strftime(ts, '%Y/%m/%d') || '/part.json'
          LIKE '%postgres_cdc/customers/2024/01/1%' GROUP BY 1
    """,
)
def rows_of_matching_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.event_raw(spark, sf_dir).filter(F.col(SOURCE_FILE).contains("postgres_cdc/customers/2024/01/1"))
    day = F.regexp_extract(SOURCE_FILE, r"customers/(\d+/\d+/\d+)/", 1).alias("day")
    return raw.groupBy(day).agg(F.count("*").alias("n_rows"))


@query(
    "dq_id_length",
    """
    SELECT count(*) AS n_rows, count(*) FILTER (WHERE length(id) IN (15, 18)) AS n_ok,
           count(*) FILTER (WHERE id IS NULL OR length(id) NOT IN (15, 18)) AS n_bad
    FROM (
      SELECT CASE c_custkey % 4 WHEN 0 THEN lpad(CAST(c_custkey AS VARCHAR), 18, '0')
             WHEN 1 THEN lpad(CAST(c_custkey AS VARCHAR), 15, '0')
             WHEN 2 THEN lpad(CAST(c_custkey AS VARCHAR), 16, '0') END AS id FROM customer)
    """,
)
def record_ids_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of 18, 15 and 16 characters, and records without one."""
    key = F.col("c_custkey")
    record_id = (
        F.when(key % 4 == 0, F.lpad(key.cast("string"), 18, "0"))
        .when(key % 4 == 1, F.lpad(key.cast("string"), 15, "0"))
        .when(key % 4 == 2, F.lpad(key.cast("string"), 16, "0"))
    )
    raw = feeds.table(spark, sf_dir, "customer").select(feeds.record(Id=record_id).alias("_raw_json"))
    return checks.id_length_check(raw)


@query(
    "active_rows",
    """
    SELECT lpad(CAST(c_custkey AS VARCHAR), 18, '0') AS sf_id, c_name AS name FROM customer WHERE c_custkey % 9 <> 0
    """,
)
def accounts_not_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(feeds.customer_objects(spark, sf_dir), ACCOUNTS)
    table = merge_upsert(None, rows, ACCOUNTS, load_ts=feeds.FIRST_LOAD)
    return checks.active_rows(table).select("sf_id", "name")


@query(
    "non_empty",
    """
    SELECT 'accounts_raw' AS table_name, count(*) > 0 AS has_rows FROM supplier
    UNION ALL SELECT 'contacts_raw', count(*) > 0 FROM customer
    UNION ALL SELECT 'customers_raw', count(*) > 0 FROM events
    UNION ALL SELECT 'orders_raw', count(*) > 0 FROM orders
    UNION ALL SELECT 'nothing', FALSE
    """,
)
def tables_with_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = raw_tables(spark, sf_dir)
    tables["nothing"] = feeds.table(spark, sf_dir, "orders").filter(F.col("o_orderkey") < 0)
    return checks.non_empty_report(tables)


CONFORMANCE_FIELDS = (
    Field("id", "bigint", "$.id"),
    Field("amount", "decimal(12,2)", "$.amount"),
    Field("order_date", "date", "$.order_date"),
    Field("note", "string", "$.note"),
)


@query(
    "field_conformance",
    """
    WITH n AS (SELECT count(*) AS n_rows FROM events)
    SELECT n_rows, 'id' AS field, CAST(0 AS BIGINT) AS n_null, CAST(0 AS BIGINT) AS n_bad FROM n
    UNION ALL
    SELECT n_rows, 'amount', CAST(0 AS BIGINT), (SELECT count(*) FROM events WHERE event_id % 13 = 0) FROM n
    UNION ALL
    SELECT n_rows, 'order_date', (SELECT count(*) FROM events WHERE event_type = 'view'),
           (SELECT count(*) FROM events WHERE event_type = 'error') FROM n
    UNION ALL
    SELECT n_rows, 'note', n_rows, CAST(0 AS BIGINT) FROM n
    """,
)
def fields_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts that are words, dates that are missing or broken, and a field that is always null."""
    amount = F.when(F.col("event_id") % 13 == 0, '"n/a"').otherwise(F.col("value").cast("decimal(12,2)").cast("string"))
    day = (
        F.when(F.col("event_type") == "view", "null")
        .when(F.col("event_type") == "error", '"2024-13-45"')
        .otherwise(F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"')))
    )
    line = F.format_string('{"id": %d, "amount": %s, "order_date": %s, "note": null}', F.col("user_id"), amount, day)
    good, _ = parse_records(feeds.table(spark, sf_dir, "events").select(line.alias("value")))
    return checks.field_conformance(good.withColumnRenamed("record", "_raw_json"), CONFORMANCE_FIELDS)


@query(
    "required_nulls",
    """
    WITH n AS (SELECT count(*) AS n_rows FROM (SELECT s_suppkey AS k FROM supplier UNION SELECT c_custkey FROM customer))
    SELECT n_rows, 'sf_id' AS column_name, CAST(0 AS BIGINT) AS n_null FROM n
    UNION ALL SELECT n_rows, 'name', CAST(0 AS BIGINT) FROM n
    UNION ALL SELECT n_rows, 'is_deleted', CAST(0 AS BIGINT) FROM n
    UNION ALL SELECT n_rows, '_etl_loaded_at', CAST(0 AS BIGINT) FROM n
    UNION ALL SELECT n_rows, 'website', n_rows FROM n
    """,
)
def required_columns_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = typed(feeds.supplier_objects(spark, sf_dir), ACCOUNTS)
    second = typed(feeds.customer_objects(spark, sf_dir), ACCOUNTS)
    target = merge_upsert(None, first, ACCOUNTS, load_ts=feeds.FIRST_LOAD)
    table = merge_upsert(target, second, ACCOUNTS, load_ts=feeds.SECOND_LOAD)
    return checks.required_nulls(table, ["sf_id", "name", "is_deleted", "_etl_loaded_at", "website"])


def event_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load history of the minute polls that bring in the events."""
    raw = feeds.event_raw(spark, sf_dir)
    return raw.groupBy(F.lit("customers_raw").alias("table_name"), F.col(LOADED_AT).alias("last_load_time")).agg(
        F.count("*").alias("row_count")
    )


@query(
    "throughput",
    f"""
    SELECT 'customers_raw' AS table_name, count(*) AS n_rows, count(*) / 864000 AS rows_per_second
    FROM (SELECT {LOADED_AT_SQL} AS loaded_at FROM events)
    WHERE loaded_at > TIMESTAMP '2024-01-10' AND loaded_at <= TIMESTAMP '2024-01-20'
    """,
)
def load_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watch.throughput(event_loads(spark, sf_dir), "2024-01-10 00:00:00", "2024-01-20 00:00:00")


@query(
    "count_growth",
    f"""
    SELECT 'customers_raw' AS table_name, count(*) FILTER (WHERE {LOADED_AT_SQL} <= TIMESTAMP '2024-01-16') AS n_before,
           count(*) AS n_after, FALSE AS has_dropped FROM events
    """,
)
def rows_before_and_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.event_raw(spark, sf_dir)
    before = watch.row_counts({"customers_raw": raw.filter(F.col(LOADED_AT) <= feeds.at("2024-01-16"))})
    return watch.growth(before, watch.row_counts({"customers_raw": raw}))


@query(
    "propagation_latency",
    f"""
    SELECT event_type AS feed, count(*) AS n_rows, CAST(sum(s) AS BIGINT) / count(*) AS avg_seconds,
           max(s) AS max_seconds, quantile_cont(s, 0.95) AS p95_seconds
    FROM (SELECT event_type, CAST(epoch({LOADED_AT_SQL}) AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events)
    GROUP BY 1
    """,
)
def delay_from_change_to_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(feeds.event_raw(spark, sf_dir), CUSTOMERS).withColumn("feed", F.col("status"))
    return watch.latency(rows, "updated_at", "feed")


@query(
    "latency_of_loads",
    f"""
    WITH s AS (SELECT CAST(epoch({LOADED_AT_SQL}) AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events)
    SELECT count(*) AS n_rows, CAST(sum(s) AS BIGINT) / count(*) AS avg_seconds, max(s) AS max_seconds, TRUE AS p95_in_bounds
    FROM s
    """,
)
def delay_from_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delays of all loads from their merged summaries; the 95th percentile is within a hundredth of its rank."""
    told = sketches.merged_latency(summarised_loads(spark, sf_dir, "latency_of_loads"), 0.95)
    at = told.first()["quantile_seconds"]
    rows = typed(feeds.event_raw(spark, sf_dir), CUSTOMERS)
    second = F.unix_seconds(F.col(LOADED_AT).cast("timestamp")) - F.unix_seconds(F.col("updated_at").cast("timestamp"))
    shares = rows.agg((F.count_if(second < at) / F.count("*")).alias("below"), (F.count_if(second <= at) / F.count("*")).alias("upto")).first()
    in_bounds = shares["below"] <= 0.96 and shares["upto"] >= 0.94
    return told.select("n_rows", "avg_seconds", "max_seconds", F.lit(in_bounds).alias("p95_in_bounds"))


@query(
    "raw_columns",
    """
    SELECT column_name, TRUE AS is_there, TRUE AS has_type, n_rows,
           CASE WHEN column_name = '_key' THEN n_bad ELSE 0 END AS n_null, CAST(0 AS BIGINT) AS n_long
    FROM (VALUES ('_raw_json'), ('_cdc_operation'), ('_cdc_timestamp'), ('_loaded_at'), ('_source_file'), ('_batch_id'),
                 ('_record_pos'), ('_key')) AS c(column_name),
         (SELECT count(*) AS n_rows, count(*) FILTER (WHERE event_id % 19 = 0) AS n_bad FROM events)
    UNION ALL
    SELECT '_missing', FALSE, FALSE, count(*), NULL, NULL FROM events
    """,
)
def raw_columns_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lineage columns of a stored raw table, its key column, and one that is not there."""
    raw = feeds.event_raw(spark, sf_dir)
    number = F.variant_get("_raw_json", "$.sequence", "bigint")
    odd = F.to_variant_object(F.struct(F.lit("none").alias("id"), number.alias("sequence")))
    store = Store(spark, scratch_dir(spark, "raw_columns"))
    store.write_landed(raw.withColumn("_raw_json", F.when(number % 19 == 0, odd).otherwise(F.col("_raw_json"))), CUSTOMERS, 0)
    expected = StructType([*CUSTOMERS.raw_schema.fields, StructField("_key", LongType()), StructField("_missing", StringType())])
    return checks.column_conformance(store.raw(CUSTOMERS), expected)
