"""Queries over typed tables: latest rows, merges, change logs, late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.typed import typed
from millrace.operators.latest import latest_per_key, newest_rows
from millrace.operators.merge import apply_changelog, as_changes, fold_loads, insert_all, merge_upsert
from millrace.plans import feeds
from millrace.plans.registry import query
from millrace.specs import ACCOUNTS, CONTACTS, CUSTOMERS, LOAD_ID, ORDERS, TableSpec

CHANGELOG_CUSTOMERS = CUSTOMERS.as_changelog()


def merged(first: DataFrame, second: DataFrame, spec: TableSpec) -> DataFrame:
    """Two raw batches merged in turn into an empty table."""
    target = merge_upsert(None, typed(first, spec), spec, load_ts=feeds.FIRST_LOAD)
    return merge_upsert(target, typed(second, spec), spec, load_ts=feeds.SECOND_LOAD)


@query(
    "latest_per_key",
    """
    SELECT user_id AS id, event_type AS status, ts AS updated_at, 'UPSERT' AS operation
    FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def latest_row_of_each_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(feeds.event_raw(spark, sf_dir), CUSTOMERS)
    latest = latest_per_key(rows, ["id"], CUSTOMERS.order_names)
    return latest.select("id", "status", "updated_at", F.col("_cdc_operation").alias("operation"))


@query(
    "newest_rows",
    """
    SELECT user_id AS id, event_id AS sequence, 'UPSERT' AS operation,
           date_trunc('minute', ts) + INTERVAL 65 SECOND AS loaded_at,
           'staged/postgres_cdc/customers/' || strftime(ts, '%Y/%m/%d') || '/part.json' AS source_file
    FROM events
    ORDER BY loaded_at DESC, event_id DESC
    LIMIT 5
    """,
)
def newest_raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.event_raw(spark, sf_dir)
    return newest_rows(raw, ["_loaded_at", "_record_pos"], 5).select(
        F.variant_get("_raw_json", "$.id", "bigint").alias("id"),
        F.variant_get("_raw_json", "$.sequence", "bigint").alias("sequence"),
        F.col("_cdc_operation").alias("operation"),
        F.col("_loaded_at").alias("loaded_at"),
        F.col("_source_file").alias("source_file"),
    )


# The customer table as first load, shared by the SQL of several merges.
FIRST_CUSTOMERS_SQL = """
  SELECT c_custkey + 100 AS id, 'Customer' AS first_name, substring(c_name, 10, 9) AS last_name,
         lower(c_name) || '@example.invalid' AS email, lower(c_mktsegment) AS status,
         TIMESTAMP '2023-12-31' AS created_at,
         TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 60 AS INTEGER)) AS updated_at
  FROM customer
"""


@query(
    "merge_customers",
    f"""
    WITH t AS ({FIRST_CUSTOMERS_SQL}),
    s AS (
      SELECT user_id AS id, 'User' AS first_name, CAST(user_id AS VARCHAR) AS last_name,
             'u' || user_id || '@example.invalid' AS email, event_type AS status, ts AS created_at, ts AS updated_at,
             'staged/postgres_cdc/customers/' || strftime(ts, '%Y/%m/%d') || '/part.json' AS batch
      FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    ),
    j AS (
      SELECT t.id AS t_id, s.id AS s_id, t.*, s.*,
             s.id IS NOT NULL AND (t.id IS NULL OR s.updated_at >= t.updated_at) AS wins
      FROM t FULL OUTER JOIN s ON t.id = s.id
    )
    SELECT coalesce(t_id, s_id) AS id,
           CASE WHEN wins THEN first_name_1 ELSE first_name END AS first_name,
           CASE WHEN wins THEN last_name_1 ELSE last_name END AS last_name,
           CASE WHEN wins THEN email_1 ELSE email END AS email,
           CAST(NULL AS VARCHAR) AS phone,
           CASE WHEN wins THEN status_1 ELSE status END AS status,
           CASE WHEN t_id IS NULL THEN created_at_1 ELSE created_at END AS created_at,
           CASE WHEN wins THEN updated_at_1 ELSE updated_at END AS updated_at,
           FALSE AS is_deleted, 'UPSERT' AS operation,
           CASE WHEN wins THEN date_trunc('minute', updated_at_1) + INTERVAL 65 SECOND
                ELSE TIMESTAMP '2024-01-01' END AS cdc_timestamp,
           CASE WHEN wins THEN TIMESTAMP '2024-02-02' ELSE TIMESTAMP '2024-02-01' END AS loaded_at,
           CASE WHEN wins THEN batch ELSE 'staged/postgres_cdc/customers/2024/01/01/first.json' END AS batch_id
    FROM j
    """,
)
def merge_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merged(feeds.customer_raw(spark, sf_dir), feeds.event_raw(spark, sf_dir), CUSTOMERS)
    return out.withColumnsRenamed(
        {
            "_cdc_operation": "operation",
            "_cdc_timestamp": "cdc_timestamp",
            "_etl_loaded_at": "loaded_at",
            "_etl_batch_id": "batch_id",
        }
    )


@query(
    "merge_orders",
    """
    WITH t AS (
      SELECT o_orderkey AS id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
             o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
             o_orderdate AS updated_at
      FROM orders
    ),
    s AS (
      SELECT l_orderkey + 5000 AS id, l_suppkey AS customer_id, CAST(l_shipdate AS DATE) AS order_date,
             l_returnflag || l_linestatus AS status, CAST(l_extendedprice AS DECIMAL(12,2)) AS total_amount,
             l_shipdate AS updated_at
      FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_shipdate DESC, l_partkey DESC, l_extendedprice DESC, l_linenumber DESC) = 1
    ),
    j AS (
      SELECT t.id AS t_id, s.id AS s_id, t.*, s.*,
             s.id IS NOT NULL AND (t.id IS NULL OR s.updated_at >= t.updated_at) AS wins
      FROM t FULL OUTER JOIN s ON t.id = s.id
    )
    SELECT coalesce(t_id, s_id) AS id,
           CASE WHEN wins THEN customer_id_1 ELSE customer_id END AS customer_id,
           CASE WHEN t_id IS NULL THEN order_date_1 ELSE order_date END AS order_date,
           CASE WHEN wins THEN status_1 ELSE status END AS status,
           CASE WHEN wins THEN total_amount_1 ELSE total_amount END AS total_amount,
           CASE WHEN t_id IS NULL THEN 'EUR' ELSE 'GBP' END AS currency,
           CAST(NULL AS VARCHAR) AS shipping_address, CAST(NULL AS VARCHAR) AS notes,
           CAST(CASE WHEN t_id IS NULL THEN order_date_1 ELSE order_date END AS TIMESTAMP) AS created_at,
           CASE WHEN wins THEN updated_at_1 ELSE updated_at END AS updated_at,
           FALSE AS is_deleted
    FROM j
    """,
)
def merge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merged(feeds.order_raw(spark, sf_dir), feeds.line_raw(spark, sf_dir), ORDERS)
    return out.drop("_cdc_operation", "_cdc_timestamp", "_etl_loaded_at", "_etl_batch_id")


@query(
    "merge_accounts",
    """
    WITH t AS (
      SELECT lpad(CAST(s_suppkey AS VARCHAR), 18, '0') AS sf_id, s_name AS name, 'Supply' AS industry,
             CAST(s_acctbal AS DECIMAL(18,2)) AS annual_revenue, CAST(s_nationkey AS VARCHAR) AS billing_country,
             lpad(CAST(s_nationkey AS VARCHAR), 18, '0') AS owner_id, CAST(NULL AS BIGINT) AS number_of_employees,
             TIMESTAMP '2024-01-01' + to_days(CAST(s_suppkey % 30 AS INTEGER)) AS last_modified_date,
             FALSE AS is_deleted
      FROM supplier
    ),
    s AS (
      SELECT lpad(CAST(c_custkey AS VARCHAR), 18, '0') AS sf_id, c_name AS name, c_mktsegment AS industry,
             CAST(c_acctbal AS DECIMAL(18,2)) AS annual_revenue, CAST(c_nationkey AS VARCHAR) AS billing_country,
             CAST(NULL AS VARCHAR) AS owner_id, c_custkey % 500 AS number_of_employees,
             TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 45 AS INTEGER)) AS last_modified_date,
             c_custkey % 9 = 0 AS is_deleted
      FROM customer
    ),
    j AS (
      SELECT t.sf_id AS t_id, s.sf_id AS s_id, t.*, s.*,
             s.sf_id IS NOT NULL AND (t.sf_id IS NULL OR s.last_modified_date >= t.last_modified_date) AS wins
      FROM t FULL OUTER JOIN s ON t.sf_id = s.sf_id
    )
    SELECT coalesce(t_id, s_id) AS sf_id,
           CASE WHEN wins THEN name_1 ELSE name END AS name,
           CASE WHEN wins THEN industry_1 ELSE industry END AS industry,
           CASE WHEN wins THEN annual_revenue_1 ELSE annual_revenue END AS annual_revenue,
           CAST(NULL AS VARCHAR) AS billing_city,
           CASE WHEN wins THEN billing_country_1 ELSE billing_country END AS billing_country,
           CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS website,
           CASE WHEN wins THEN number_of_employees_1 ELSE number_of_employees END AS number_of_employees,
           CASE WHEN wins THEN owner_id_1 ELSE owner_id END AS owner_id,
           CASE WHEN t_id IS NULL THEN TIMESTAMP '2024-01-05' ELSE TIMESTAMP '2024-01-01' END AS created_date,
           CASE WHEN wins THEN last_modified_date_1 ELSE last_modified_date END AS last_modified_date,
           CASE WHEN wins THEN is_deleted_1 ELSE is_deleted END AS is_deleted
    FROM j
    """,
)
def merge_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merged(feeds.supplier_objects(spark, sf_dir), feeds.customer_objects(spark, sf_dir), ACCOUNTS)
    return out.drop("_etl_loaded_at", "_etl_batch_id")


@query(
    "merge_contacts",
    """
    WITH t AS (
      SELECT lpad(CAST(c_custkey + 100 AS VARCHAR), 18, '0') AS sf_id,
             lpad(CAST(c_custkey AS VARCHAR), 18, '0') AS account_id, 'Customer' AS first_name,
             substring(c_name, 10, 9) AS last_name, lower(c_name) || '@example.invalid' AS email, 'Buyer' AS title,
             c_mktsegment AS lead_source, TIMESTAMP '2024-01-01' AS created_date,
             TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 60 AS INTEGER)) AS last_modified_date,
             FALSE AS is_deleted
      FROM customer
    ),
    s AS (
      SELECT lpad(CAST(user_id AS VARCHAR), 18, '0') AS sf_id,
             lpad(CAST(user_id AS VARCHAR), 18, '0') AS account_id, 'User' AS first_name,
             CAST(user_id AS VARCHAR) AS last_name, CAST(NULL AS VARCHAR) AS email, event_type AS title,
             CAST(NULL AS VARCHAR) AS lead_source, ts AS created_date, ts AS last_modified_date,
             event_type = 'error' AS is_deleted
      FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    ),
    j AS (
      SELECT t.sf_id AS t_id, s.sf_id AS s_id, t.*, s.*,
             s.sf_id IS NOT NULL AND (t.sf_id IS NULL OR s.last_modified_date >= t.last_modified_date) AS wins
      FROM t FULL OUTER JOIN s ON t.sf_id = s.sf_id
    )
    SELECT coalesce(t_id, s_id) AS sf_id,
           CASE WHEN wins THEN account_id_1 ELSE account_id END AS account_id,
           CASE WHEN wins THEN first_name_1 ELSE first_name END AS first_name,
           CASE WHEN wins THEN last_name_1 ELSE last_name END AS last_name,
           CASE WHEN wins THEN email_1 ELSE email END AS email,
           CAST(NULL AS VARCHAR) AS phone,
           CASE WHEN wins THEN title_1 ELSE title END AS title,
           CAST(NULL AS VARCHAR) AS department,
           CASE WHEN wins THEN lead_source_1 ELSE lead_source END AS lead_source,
           CAST(NULL AS VARCHAR) AS owner_id,
           CASE WHEN t_id IS NULL THEN created_date_1 ELSE created_date END AS created_date,
           CASE WHEN wins THEN last_modified_date_1 ELSE last_modified_date END AS last_modified_date,
           CASE WHEN wins THEN is_deleted_1 ELSE is_deleted END AS is_deleted
    FROM j
    """,
)
def merge_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merged(feeds.customer_contacts(spark, sf_dir), feeds.event_contacts(spark, sf_dir), CONTACTS)
    return out.drop("_etl_loaded_at", "_etl_batch_id")


@query(
    "apply_changelog",
    f"""
    WITH t AS ({FIRST_CUSTOMERS_SQL}),
    e AS (
      SELECT *, CASE WHEN event_id % 10 = 0 THEN 'DELETE' WHEN event_id % 10 <= 3 THEN 'UPDATE' ELSE 'INSERT' END AS op
      FROM events
    ),
    s AS (
      SELECT user_id AS id,
             arg_max(op, (ts, event_id)) AS op, max(ts) AS last_ts,
             arg_max(event_type, (ts, event_id)) FILTER (WHERE op <> 'DELETE') AS status,
             min(ts) FILTER (WHERE op <> 'DELETE') AS created_at,
             max(ts) FILTER (WHERE op <> 'DELETE') AS data_ts
      FROM e GROUP BY user_id
    )
    SELECT coalesce(t.id, s.id) AS id,
           CASE WHEN s.data_ts IS NOT NULL THEN 'User' ELSE t.first_name END AS first_name,
           CASE WHEN s.data_ts IS NOT NULL THEN s.status ELSE t.status END AS status,
           CASE WHEN t.id IS NULL THEN s.created_at ELSE t.created_at END AS created_at,
           CASE WHEN s.id IS NOT NULL THEN s.last_ts ELSE t.updated_at END AS updated_at,
           coalesce(s.op = 'DELETE', FALSE) AS is_deleted,
           coalesce(s.op, 'UPSERT') AS operation,
           coalesce(s.last_ts, TIMESTAMP '2024-01-01') AS cdc_timestamp
    FROM t FULL OUTER JOIN s ON t.id = s.id
    WHERE t.id IS NOT NULL OR s.data_ts IS NOT NULL
    """,
)
def changelog_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = typed(feeds.customer_raw(spark, sf_dir), CUSTOMERS)
    target = merge_upsert(None, first, CUSTOMERS, load_ts=feeds.FIRST_LOAD)
    changes = typed(feeds.event_changes(spark, sf_dir), CHANGELOG_CUSTOMERS)
    return apply_changelog(target, changes, CHANGELOG_CUSTOMERS).select(
        "id",
        "first_name",
        "status",
        "created_at",
        "updated_at",
        "is_deleted",
        F.col("_cdc_operation").alias("operation"),
        F.col("_cdc_timestamp").alias("cdc_timestamp"),
    )


@query(
    "soft_delete_status",
    """
    SELECT user_id AS id, CASE event_type WHEN 'error' THEN 'deleted' WHEN 'purchase' THEN 'premium' ELSE 'active' END AS status,
           ts AS updated_at, FALSE AS is_deleted
    FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def soft_delete_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(feeds.event_raw(spark, sf_dir), CUSTOMERS)
    status = F.when(F.col("status") == "error", "deleted").when(F.col("status") == "purchase", "premium")
    rows = rows.withColumn("status", status.otherwise("active"))
    out = merge_upsert(None, rows, CUSTOMERS, load_ts=feeds.FIRST_LOAD)
    return out.select("id", "status", "updated_at", "is_deleted")


@query(
    "merge_idempotent",
    """
    WITH k AS (SELECT c_custkey + 100 AS id FROM customer UNION SELECT user_id FROM events)
    SELECT count(*) AS n_once, count(*) AS n_twice, CAST(0 AS BIGINT) AS n_different FROM k
    """,
)
def merge_is_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = typed(feeds.customer_raw(spark, sf_dir), CUSTOMERS)
    second = typed(feeds.event_raw(spark, sf_dir), CUSTOMERS)
    target = merge_upsert(None, first, CUSTOMERS, load_ts=feeds.FIRST_LOAD)
    once = merge_upsert(target, second, CUSTOMERS, load_ts=feeds.FIRST_LOAD)
    twice = merge_upsert(once, second, CUSTOMERS, load_ts=feeds.SECOND_LOAD)
    kept = [c for c in CUSTOMERS.typed_columns if c != "_etl_loaded_at"]
    a = once.select("id", F.struct(*kept).alias("a"))
    b = twice.select("id", F.struct(*kept).alias("b"))
    return a.join(b, "id", "full_outer").agg(
        F.count("a").alias("n_once"),
        F.count("b").alias("n_twice"),
        F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_different"),
    )


# Events split in three batches that arrive newest first.
LATE_BATCH_SQL = "CASE WHEN ts >= TIMESTAMP '2024-01-21' THEN 0 WHEN ts >= TIMESTAMP '2024-01-11' THEN 1 ELSE 2 END"


@query(
    "late_row_guard",
    f"""
    WITH e AS (SELECT *, {LATE_BATCH_SQL} AS batch FROM events),
    w AS (
      SELECT user_id, batch, ts, event_type,
             row_number() OVER (PARTITION BY user_id, batch ORDER BY ts DESC, event_id DESC) AS r
      FROM e
    )
    SELECT user_id AS id, arg_max(event_type, ts) AS status, max(ts) AS updated_at, arg_min(ts, batch) AS created_at
    FROM w WHERE r = 1 GROUP BY user_id
    """,
)
def late_rows_do_not_win(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(feeds.event_raw(spark, sf_dir), CUSTOMERS)
    updated = F.col("updated_at")
    batches = [
        updated >= feeds.at("2024-01-21"),
        (updated >= feeds.at("2024-01-11")) & (updated < feeds.at("2024-01-21")),
        updated < feeds.at("2024-01-11"),
    ]
    target = None
    for batch in batches:
        target = merge_upsert(target, rows.filter(batch), CUSTOMERS, load_ts=feeds.FIRST_LOAD)
    return target.select("id", "status", "updated_at", "created_at")


@query(
    "fold_loads",
    f"""
    WITH e AS (SELECT *, {LATE_BATCH_SQL} AS batch FROM events),
    w AS (
      SELECT user_id, batch, ts, event_type,
             row_number() OVER (PARTITION BY user_id, batch ORDER BY ts DESC, event_id DESC) AS r
      FROM e
    )
    SELECT user_id AS id, arg_max(event_type, ts) AS status, max(ts) AS updated_at, arg_min(ts, batch) AS created_at
    FROM w WHERE r = 1 GROUP BY user_id
    """,
)
def many_loads_in_one_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(feeds.event_raw(spark, sf_dir), CUSTOMERS)
    updated = F.col("updated_at")
    load = F.when(updated >= feeds.at("2024-01-21"), 0).when(updated >= feeds.at("2024-01-11"), 1).otherwise(2)
    loads = rows.withColumn(LOAD_ID, load)
    newest = latest_per_key(loads, ["id", LOAD_ID], CUSTOMERS.order_names)
    changes = as_changes(newest, CUSTOMERS, feeds.FIRST_LOAD, LOAD_ID)
    folded = insert_all(fold_loads(changes, CUSTOMERS), CUSTOMERS)
    return folded.select("id", "status", "updated_at", "created_at")
