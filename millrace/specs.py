"""Table specifications: record paths, types, keys and the two column lists of a merge."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

LINEAGE_OP = "_cdc_operation"
LINEAGE_TS = "_cdc_timestamp"
LOADED_AT = "_loaded_at"
SOURCE_FILE = "_source_file"
BATCH_ID = "_batch_id"
RECORD = "_raw_json"
POSITION = "_record_pos"
RAW_KEY = "_key"
RAW_CURSOR = "_cursor"
LOAD_ID = "_load_id"
ETL_LOADED_AT = "_etl_loaded_at"
ETL_BATCH_ID = "_etl_batch_id"


@dataclass(frozen=True)
class Field:
    """One typed column and where its value sits in the record.

    ``path`` is None for a column the feed never fills. ``length`` is the longest
    string kept. ``unit='millis'`` reads an integer as epoch milliseconds.
    """

    name: str
    type: str
    path: str | None = None
    length: int | None = None
    unit: str | None = None


@dataclass(frozen=True)
class TableSpec:
    """What the merge of one table needs to know."""

    name: str
    namespace: str
    key: str
    fields: tuple[Field, ...]
    inserted: tuple[str, ...]
    updated: tuple[str, ...]
    cursor: str
    change_columns: bool = True
    has_deleted_flag: bool = True
    changelog: bool = False

    @property
    def raw_name(self) -> str:
        return f"{self.name}_raw"

    @property
    def folder(self) -> str:
        """The table's name in folders; a change log's rows never lie beside those of polls."""
        return f"{self.name}_changelog" if self.changelog else self.name

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    @property
    def carries_deleted(self) -> bool:
        """True when the record itself tells whether the row is deleted."""
        return any(f.name == "is_deleted" for f in self.fields)

    @property
    def change_names(self) -> tuple[str, ...]:
        return (LINEAGE_OP, LINEAGE_TS) if self.change_columns else ()

    @property
    def order_names(self) -> tuple[str, ...]:
        """Newest-first order of raw rows of one key, most important first."""
        tail = (LOADED_AT, SOURCE_FILE, POSITION)
        if self.changelog:
            return (LINEAGE_TS, *tail)
        if self.change_columns:
            return (self.cursor, LINEAGE_TS, *tail)
        return (self.cursor, *tail)

    @property
    def guard_names(self) -> tuple[str, ...]:
        """The part of the order that a typed row still carries."""
        if self.changelog:
            return (LINEAGE_TS,)
        return (self.cursor, *self.change_names[1:])

    @property
    def insert_only(self) -> tuple[str, ...]:
        return tuple(c for c in self.inserted if c not in self.updated and c != self.key)

    @property
    def typed_schema(self) -> T.StructType:
        out = T.StructType()
        for f in self.fields:
            if f.name != "is_deleted":
                out.add(_struct_field(f, nullable=f.name != self.key))
        if self.has_deleted_flag:
            out.add("is_deleted", T.BooleanType(), True)
        if self.change_columns:
            out.add(LINEAGE_OP, T.StringType(), True, {"max_length": 10})
            out.add(LINEAGE_TS, T.TimestampNTZType(), True)
        out.add(ETL_LOADED_AT, T.TimestampNTZType(), True)
        out.add(ETL_BATCH_ID, T.StringType(), True, {"max_length": 100})
        return out

    @property
    def typed_columns(self) -> tuple[str, ...]:
        return tuple(self.typed_schema.names)

    @property
    def raw_schema(self) -> T.StructType:
        out = T.StructType().add(RECORD, T.VariantType())
        if self.change_columns:
            out.add(LINEAGE_OP, T.StringType(), True, {"max_length": 10})
            out.add(LINEAGE_TS, T.TimestampNTZType())
        out.add(LOADED_AT, T.TimestampNTZType())
        out.add(SOURCE_FILE, T.StringType(), True, {"max_length": 500})
        out.add(BATCH_ID, T.StringType(), True, {"max_length": 100})
        out.add(POSITION, POSITION_TYPE)
        return out

    def as_changelog(self) -> TableSpec:
        """The same table fed by a change log instead of polls."""
        return replace(self, changelog=True)

    def row_bytes(self) -> int:
        """Largest in-memory size of one typed row (four bytes per character); a string without a length has no bound."""
        total = 0
        for f in self.typed_schema.fields:
            limit = (f.metadata or {}).get("max_length")
            if limit is None and isinstance(f.dataType, T.StringType):
                return UNBOUNDED
            total += 16 if limit is None else 16 + 4 * limit
        return total


# More bytes than any broadcast may hold.
UNBOUNDED = 1 << 62

# Where a record stood in its file: start of the file part, line, item of an outer array.
POSITION_TYPE = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("line", T.LongType()),
        T.StructField("item", T.IntegerType()),
    ]
)


def _struct_field(f: Field, nullable: bool) -> T.StructField:
    meta = {"max_length": f.length} if f.length else {}
    return T.StructField(f.name, T.DataType.fromDDL(f.type), nullable, meta)


# ---------------------------------------------------------------------------
# Column names, types, lengths and record paths of the four tables,
# and which columns a merge inserts and which it updates.
# ---------------------------------------------------------------------------

CUSTOMERS = TableSpec(
    name="customers",
    namespace="postgres_cdc",
    key="id",
    fields=(
        Field("id", "bigint", "$.id"),
        Field("first_name", "string", "$.first_name", 100),
        Field("last_name", "string", "$.last_name", 100),
        Field("email", "string", "$.email", 255),
        Field("phone", "string", "$.phone", 50),
        Field("status", "string", "$.status", 20),
        Field("created_at", "timestamp_ntz", "$.created_at"),
        Field("updated_at", "timestamp_ntz", "$.updated_at"),
    ),
    inserted=("id", "first_name", "last_name", "email", "phone", "status", "created_at", "updated_at"),
    updated=("first_name", "last_name", "email", "phone", "status", "updated_at"),
    cursor="updated_at",
)

ORDERS = TableSpec(
    name="orders",
    namespace="postgres_cdc",
    key="id",
    fields=(
        Field("id", "bigint", "$.id"),
        Field("customer_id", "bigint", "$.customer_id"),
        Field("order_date", "date", "$.order_date"),
        Field("status", "string", "$.status", 30),
        Field("total_amount", "decimal(12,2)", "$.total_amount"),
        Field("currency", "string", "$.currency", 3),
        Field("shipping_address", "string", None, 500),
        Field("notes", "string", None, 1000),
        Field("created_at", "timestamp_ntz", "$.created_at"),
        Field("updated_at", "timestamp_ntz", "$.updated_at"),
    ),
    inserted=("id", "customer_id", "order_date", "status", "total_amount", "currency", "created_at", "updated_at"),
    updated=("customer_id", "status", "total_amount", "updated_at"),
    cursor="updated_at",
)

ACCOUNTS = TableSpec(
    name="accounts",
    namespace="salesforce",
    key="sf_id",
    fields=(
        Field("sf_id", "string", "$.Id", 18),
        Field("name", "string", "$.Name", 255),
        Field("industry", "string", "$.Industry", 100),
        Field("annual_revenue", "decimal(18,2)", "$.AnnualRevenue"),
        Field("billing_city", "string", "$.BillingCity", 100),
        Field("billing_country", "string", "$.BillingCountry", 100),
        Field("phone", "string", "$.Phone", 40),
        Field("website", "string", "$.Website", 255),
        Field("number_of_employees", "bigint", "$.NumberOfEmployees"),
        Field("owner_id", "string", "$.OwnerId", 18),
        Field("created_date", "timestamp_ntz", "$.CreatedDate"),
        Field("last_modified_date", "timestamp_ntz", "$.LastModifiedDate"),
        Field("is_deleted", "boolean", "$.IsDeleted"),
    ),
    inserted=(
        "sf_id", "name", "industry", "annual_revenue", "billing_city", "billing_country", "phone", "website",
        "number_of_employees", "owner_id", "created_date", "last_modified_date", "is_deleted",
    ),
    updated=(
        "name", "industry", "annual_revenue", "billing_city", "billing_country", "phone", "website",
        "number_of_employees", "owner_id", "last_modified_date", "is_deleted",
    ),
    cursor="last_modified_date",
    change_columns=False,
)

CONTACTS = TableSpec(
    name="contacts",
    namespace="salesforce",
    key="sf_id",
    fields=(
        Field("sf_id", "string", "$.Id", 18),
        Field("account_id", "string", "$.AccountId", 18),
        Field("first_name", "string", "$.FirstName", 40),
        Field("last_name", "string", "$.LastName", 80),
        Field("email", "string", "$.Email", 80),
        Field("phone", "string", "$.Phone", 40),
        Field("title", "string", "$.Title", 128),
        Field("department", "string", "$.Department", 80),
        Field("lead_source", "string", "$.LeadSource", 40),
        Field("owner_id", "string", "$.OwnerId", 18),
        Field("created_date", "timestamp_ntz", "$.CreatedDate"),
        Field("last_modified_date", "timestamp_ntz", "$.LastModifiedDate"),
        Field("is_deleted", "boolean", "$.IsDeleted"),
    ),
    inserted=(
        "sf_id", "account_id", "first_name", "last_name", "email", "phone", "title", "department", "lead_source",
        "owner_id", "created_date", "last_modified_date", "is_deleted",
    ),
    updated=(
        "account_id", "first_name", "last_name", "email", "phone", "title", "department", "lead_source",
        "owner_id", "last_modified_date", "is_deleted",
    ),
    cursor="last_modified_date",
    change_columns=False,
)

# Operation names and the constant a polled feed writes.
OP_POLLED = "UPSERT"
OP_INSERT = "INSERT"
OP_UPDATE = "UPDATE"
OP_DELETE = "DELETE"

# Lengths of a valid object record id.
RECORD_ID_LENGTHS = (15, 18)

SPECS: dict[str, TableSpec] = {s.name: s for s in (CUSTOMERS, ORDERS, ACCOUNTS, CONTACTS)}


def table_ddl(spec: TableSpec, qualified_name: str) -> str:
    """CREATE TABLE text of the typed table, with its NOT NULL key and column defaults.

    Parquet tables take no key constraint; the merge keeps the key unique.
    """
    defaults = {"is_deleted": "FALSE", ETL_LOADED_AT: "localtimestamp()"}
    return _ddl(qualified_name, spec.typed_schema, defaults)


def raw_table_ddl(spec: TableSpec, qualified_name: str) -> str:
    """CREATE TABLE text of the raw landing table, with its load-time default."""
    return _ddl(qualified_name, spec.raw_schema, {LOADED_AT: "localtimestamp()"})


def _ddl(name: str, schema: T.StructType, defaults: dict[str, str]) -> str:
    lines = []
    for f in schema.fields:
        line = f"{f.name} {f.dataType.simpleString()}"
        if not f.nullable:
            line += " NOT NULL"
        if f.name in defaults:
            line += f" DEFAULT {defaults[f.name]}"
        lines.append(line)
    body = ",\n  ".join(lines)
    return f"CREATE TABLE IF NOT EXISTS {name} (\n  {body}\n) USING parquet"
