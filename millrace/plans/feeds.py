"""The given tables seen as the feeds: which column plays which part of a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.folders import folder_bytes
from millrace.sources.landing import to_raw
from millrace.specs import (
    ACCOUNTS,
    CONTACTS,
    CUSTOMERS,
    OP_DELETE,
    OP_INSERT,
    OP_POLLED,
    OP_UPDATE,
    ORDERS,
    POSITION,
    POSITION_TYPE,
    SOURCE_FILE,
)

# Fixed values below: record field names as the specs' paths have them.
# Load times are literals here, so results do not depend on the clock.
FIRST_LOAD = "2024-02-01 00:00:00"
SECOND_LOAD = "2024-02-02 00:00:00"


# A table of so many bytes is worth a shuffle if its file cannot be split.
SPREAD_BYTES = 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. One whose files leave most cores idle, such as one row group, is spread over them before any work on its rows."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    rows, cores = spark.read.parquet(path), spark.sparkContext.defaultParallelism
    if folder_bytes(spark, path) < SPREAD_BYTES or 2 * rows.rdd.getNumPartitions() > cores:
        return rows
    return rows.repartition(cores, rows.columns[0])


# What one task makes into records of a given table: bytes of its files, which are many times as large as records, and rows, since files
# of few distinct values hold many of them.
RECORD_BYTES, RECORD_ROWS = 4 * 1024 * 1024, 200_000


def record_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table whose rows become records: spread while they are narrow, so that no task lands more than about RECORD_BYTES of files or RECORD_ROWS rows."""
    rows, path = table(spark, sf_dir, name), f"{sf_dir.rstrip('/')}/{name}.parquet"
    held = spark.read.parquet(path).count()  # from the footers
    tasks = max(-(-folder_bytes(spark, path) // RECORD_BYTES), -(-held // RECORD_ROWS))
    return rows.repartition(tasks, rows.columns[0]) if tasks > rows.rdd.getNumPartitions() else rows


def record(**fields: Column) -> Column:
    return F.to_variant_object(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("record")


def text(value: str) -> Column:
    return F.lit(value)


def null_text() -> Column:
    return F.lit(None).cast("string")


def at(moment: str) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def days_after(moment: str, days: Column) -> Column:
    return at(moment) + F.make_dt_interval(days=days)


def position(line: Column) -> Column:
    """Place of a record in its file, for feeds that were never files."""
    return F.struct(F.lit(0).cast("bigint"), line.cast("bigint"), F.lit(0)).cast(POSITION_TYPE).alias(POSITION)


def money(value: Column, digits: int = 12) -> Column:
    return value.cast(f"decimal({digits},2)")


def object_id(number: Column) -> Column:
    """An 18-character object id."""
    return F.lpad(number.cast("string"), 18, "0")


# -- change feed: events ----------------------------------------------------


def event_file(feed: str = "staged/postgres_cdc/customers") -> Column:
    """One staged file a day."""
    return F.concat(F.lit(f"{feed}/"), F.date_format("ts", "yyyy/MM/dd"), F.lit("/part.json"))


def poll_time() -> Column:
    """When the minute poll after an event lands its row."""
    return F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz") + F.expr("INTERVAL '65' SECOND")


def event_record() -> Column:
    return record(
        id=F.col("user_id"),
        first_name=text("User"),
        last_name=F.col("user_id").cast("string"),
        email=F.concat(text("u"), F.col("user_id").cast("string"), text("@example.invalid")),
        phone=null_text(),
        status=F.col("event_type"),
        created_at=F.col("ts"),
        updated_at=F.col("ts"),
        sequence=F.col("event_id"),
        amount=money(F.col("value")),
    )


def event_operation() -> Column:
    """Operation of a change-log event by its number: one delete and three updates in ten."""
    digit = F.col("event_id") % 10
    return F.when(digit == 0, OP_DELETE).when(digit <= 3, OP_UPDATE).otherwise(OP_INSERT)


def event_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customer rows, several per customer, as minute polls would land them."""
    events = record_table(spark, sf_dir, "events")
    rows = events.select("event_id", "ts", event_record(), event_file().alias(SOURCE_FILE))
    return to_raw(rows, CUSTOMERS, OP_POLLED, poll_time(), position=position(F.col("event_id")))


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw change-log rows: the operation and time are the event's own."""
    events = record_table(spark, sf_dir, "events")
    rows = events.select(
        "event_id", "ts", event_record(), event_file().alias(SOURCE_FILE), event_operation().alias("op")
    )
    return to_raw(
        rows,
        CUSTOMERS,
        F.col("op"),
        FIRST_LOAD,
        cdc_ts=F.col("ts"),
        position=position(F.col("event_id")),
    )


def event_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' own JSON texts, some cut short and some with text behind them."""
    props = F.col("props")
    cut = F.when(F.col("event_id") % 7 == 0, F.substring(props, F.lit(1), F.length(props) - 1)).otherwise(props)
    line = F.when(F.col("event_id") % 11 == 0, F.concat(cut, F.lit(" junk"))).otherwise(cut)
    return table(spark, sf_dir, "events").select(
        "event_id", line.alias("value"), event_file().alias(SOURCE_FILE), F.lit(0).cast("bigint").alias("_block")
    )


# The same rule in SQL.
EVENT_TEXT_SQL = """
  SELECT event_id,
         'staged/postgres_cdc/customers/' || strftime(ts, '%Y/%m/%d') || '/part.json' AS source_file,
         (CASE WHEN event_id % 7 = 0 THEN substring(props, 1, length(props) - 1) ELSE props END)
         || (CASE WHEN event_id % 11 = 0 THEN ' junk' ELSE '' END) AS line
  FROM events
"""

# -- customers, orders, accounts, contacts -----------------------------------

# Ids of the customer table are moved up, so that some keys of the change feed are new.
CUSTOMER_SHIFT = 100


def customer_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = record_table(spark, sf_dir, "customer").select(
        record(
            id=F.col("c_custkey") + CUSTOMER_SHIFT,
            first_name=text("Customer"),
            last_name=F.substring("c_name", 10, 9),
            email=F.concat(F.lower("c_name"), text("@example.invalid")),
            phone=null_text(),
            status=F.lower("c_mktsegment"),
            created_at=at("2023-12-31 00:00:00"),
            updated_at=days_after("2024-01-01 00:00:00", (F.col("c_custkey") % 60).cast("int")),
        ),
        F.lit("staged/postgres_cdc/customers/2024/01/01/first.json").alias(SOURCE_FILE),
        F.col("c_custkey"),
    )
    return to_raw(rows, CUSTOMERS, OP_POLLED, FIRST_LOAD, cdc_ts=at("2024-01-01 00:00:00"), position=position(F.col("c_custkey")))


def order_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = record_table(spark, sf_dir, "orders").select(
        record(
            id=F.col("o_orderkey"),
            customer_id=F.col("o_custkey"),
            order_date=F.col("o_orderdate").cast("date"),
            status=F.col("o_orderstatus"),
            total_amount=money(F.col("o_totalprice")),
            currency=text("GBP"),
            created_at=F.col("o_orderdate"),
            updated_at=F.col("o_orderdate"),
        ),
        F.lit("staged/postgres_cdc/orders/first.json").alias(SOURCE_FILE),
        F.col("o_orderkey"),
    )
    return to_raw(rows, ORDERS, OP_POLLED, FIRST_LOAD, position=position(F.col("o_orderkey")))


# Ids of the line feed are moved up, so that some of its orders are new.
LINE_SHIFT = 5000


def line_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later versions of orders, one per shipped line; often several on one day."""
    rows = record_table(spark, sf_dir, "lineitem").select(
        record(
            id=F.col("l_orderkey") + LINE_SHIFT,
            customer_id=F.col("l_suppkey"),
            order_date=F.col("l_shipdate").cast("date"),
            status=F.concat(F.col("l_returnflag"), F.col("l_linestatus")),
            total_amount=money(F.col("l_extendedprice")),
            currency=text("EUR"),
            created_at=F.col("l_shipdate"),
            updated_at=F.col("l_shipdate"),
        ),
        F.lit("staged/postgres_cdc/orders/second.json").alias(SOURCE_FILE),
        F.struct(
            F.col("l_partkey").alias("block"),
            (money(F.col("l_extendedprice")) * 100).cast("bigint").alias("line"),
            F.col("l_linenumber").alias("item"),
        ).alias(POSITION),
    )
    return to_raw(rows, ORDERS, OP_POLLED, SECOND_LOAD)


def supplier_objects(spark: SparkSession, sf_dir: str, load_ts: str = FIRST_LOAD) -> DataFrame:
    """Suppliers as account objects."""
    rows = record_table(spark, sf_dir, "supplier").select(
        record(
            Id=object_id(F.col("s_suppkey")),
            Name=F.col("s_name"),
            Industry=text("Supply"),
            AnnualRevenue=money(F.col("s_acctbal"), 18),
            BillingCountry=F.col("s_nationkey").cast("string"),
            OwnerId=object_id(F.col("s_nationkey")),
            CreatedDate=at("2024-01-01 00:00:00"),
            LastModifiedDate=days_after("2024-01-01 00:00:00", (F.col("s_suppkey") % 30).cast("int")),
            IsDeleted=F.lit(False),
        ),
        F.lit("staged/salesforce/accounts/2024-01-31/first.json").alias(SOURCE_FILE),
        F.col("s_suppkey"),
    )
    return to_raw(rows, ACCOUNTS, load_ts=load_ts, position=position(F.col("s_suppkey")))


def customer_objects(spark: SparkSession, sf_dir: str, load_ts: str = SECOND_LOAD) -> DataFrame:
    """Customers as account objects of a later pull, some of them flagged as deleted."""
    rows = record_table(spark, sf_dir, "customer").select(
        record(
            Id=object_id(F.col("c_custkey")),
            Name=F.col("c_name"),
            Industry=F.col("c_mktsegment"),
            AnnualRevenue=money(F.col("c_acctbal"), 18),
            BillingCountry=F.col("c_nationkey").cast("string"),
            NumberOfEmployees=F.col("c_custkey") % 500,
            CreatedDate=at("2024-01-05 00:00:00"),
            LastModifiedDate=days_after("2024-01-01 00:00:00", (F.col("c_custkey") % 45).cast("int")),
            IsDeleted=F.col("c_custkey") % 9 == 0,
        ),
        F.lit("staged/salesforce/accounts/2024-02-01/second.json").alias(SOURCE_FILE),
        F.col("c_custkey"),
    )
    return to_raw(rows, ACCOUNTS, load_ts=load_ts, position=position(F.col("c_custkey")))


def customer_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as contact objects."""
    rows = record_table(spark, sf_dir, "customer").select(
        record(
            Id=object_id(F.col("c_custkey") + CUSTOMER_SHIFT),
            AccountId=object_id(F.col("c_custkey")),
            FirstName=text("Customer"),
            LastName=F.substring("c_name", 10, 9),
            Email=F.concat(F.lower("c_name"), text("@example.invalid")),
            Title=text("Buyer"),
            LeadSource=F.col("c_mktsegment"),
            CreatedDate=at("2024-01-01 00:00:00"),
            LastModifiedDate=days_after("2024-01-01 00:00:00", (F.col("c_custkey") % 60).cast("int")),
            IsDeleted=F.lit(False),
        ),
        F.lit("staged/salesforce/contacts/2024-01-31/first.json").alias(SOURCE_FILE),
        F.col("c_custkey"),
    )
    return to_raw(rows, CONTACTS, load_ts=FIRST_LOAD, position=position(F.col("c_custkey")))


def event_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as contact objects of later pulls, several per contact."""
    rows = record_table(spark, sf_dir, "events").select(
        record(
            Id=object_id(F.col("user_id")),
            AccountId=object_id(F.col("user_id")),
            FirstName=text("User"),
            LastName=F.col("user_id").cast("string"),
            Title=F.col("event_type"),
            CreatedDate=F.col("ts"),
            LastModifiedDate=F.col("ts"),
            IsDeleted=F.col("event_type") == "error",
        ),
        F.lit("staged/salesforce/contacts/2024-02-01/second.json").alias(SOURCE_FILE),
        F.col("event_id"),
    )
    return to_raw(rows, CONTACTS, load_ts=SECOND_LOAD, position=position(F.col("event_id")))
