import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from helpers import at, customer, raw_customers, rows, write_file
from millrace.functions.typed import typed
from millrace.operators.checks import completeness, missing_ids, raw_key
from millrace.operators.files import expired_files, file_day, load_errors, load_history, new_files
from millrace.operators.watch import throughput
from millrace.plans.procedure import merge_cdc_batch
from millrace.sources.pulls import PullState, incremental_pull, next_hwm, object_pull, read_table
from millrace.sources.stage import LAYOUT_DAY, list_files, read_stage, stage_path, write_stage
from millrace.specs import ACCOUNTS, CONTACTS, CUSTOMERS, LOAD_ID, ORDERS
from millrace.storage import Store
from millrace.streaming.loader import (
    BadRecords,
    LoadOptions,
    load_batch,
    merge_load,
    pull_once,
    reset_pull,
    reset_stream,
    start_stream,
)

STAGE = "staged/postgres_cdc/customers/2024/01/02"
NOW = {"availableNow": True}


def lines(*records):
    return "\n".join(json.dumps(r) for r in records) + "\n"


def run(store, root, spec=CUSTOMERS, options=LoadOptions(), **kw):
    start_stream(store, root, spec, NOW, options, **kw).awaitTermination()


def ids(store, spec=CUSTOMERS):
    return sorted(r[0] for r in store.raw(spec).select(raw_key(spec)).collect())


def test_all_kinds_of_files(spark, root):
    store = Store(spark, root)
    write_file(root, f"{STAGE}/array.json", json.dumps([customer(1, "a", 1), customer(2, "a", 1)]))
    write_file(root, f"{STAGE}/lines.json", lines(customer(3, "a", 1)) + "\n\n" + lines(customer(4, "a", 1)))
    write_file(root, f"{STAGE}/bad.json", lines(customer(5, "a", 1)) + '{"id": 6,\n' + lines(customer(7, "a", 1)))
    write_file(root, f"{STAGE}/worse.json", '"text"\n')
    write_file(root, f"{STAGE}/empty.json", "")
    write_file(root, f"{STAGE}/none.json", "[]\n")
    run(store, root)
    assert ids(store) == [1, 2, 3, 4, 5, 7]
    assert [r[0] for r in rows(store.typed(CUSTOMERS), "id")] == [1, 2, 3, 4, 5, 7]
    bad = rows(store.errors(CUSTOMERS), "line", "reason")
    assert bad == [('"text"', "not an object"), ('{"id": 6,', "malformed")]
    audit = {r.file.rsplit("/", 1)[1]: r for r in store.audit(CUSTOMERS).collect()}
    assert (audit["bad.json"].status, audit["bad.json"].row_count, audit["bad.json"].error_count) == ("Partially loaded", 2, 1)
    assert audit["worse.json"].status == "Load failed" and audit["array.json"].status == "Loaded"
    raw = store.raw(CUSTOMERS).first()
    assert raw._cdc_operation == "UPSERT" and STAGE in raw._source_file and raw._batch_id == raw._source_file
    history = load_history(store.audit(CUSTOMERS), "customers_raw", "2020-01-01", only_problems=True)
    assert sorted(r.status for r in history.collect()) == ["Load failed", "Partially loaded"]
    assert load_errors(store.audit(CUSTOMERS), "dev").count() == 2
    assert load_errors(store.audit(CUSTOMERS), "prod").count() == 0


def test_whole_files_with_pretty_arrays(spark, root):
    store = Store(spark, root)
    write_file(root, f"{STAGE}/pretty.json", json.dumps([customer(1, "a", 1), customer(2, "b", 1)], indent=2))
    write_file(root, f"{STAGE}/lines.json", lines(customer(3, "a", 1), customer(4, "a", 1)))
    run(store, root, whole=True)
    assert ids(store) == [1, 2]
    assert [r.reason for r in store.errors(CUSTOMERS).collect()] == ["malformed"]


def test_each_file_is_loaded_once_and_a_restart_goes_on(spark, root):
    store = Store(spark, root)
    write_file(root, f"{STAGE}/one.json", lines(customer(1, "active", 1)))
    run(store, root)
    run(store, root)
    assert ids(store) == [1]
    for k in range(10, 15):
        write_file(root, f"{STAGE}/late{k}.json", lines(customer(k, "active", 2)))
    write_file(root, f"{STAGE}/two.json", lines(customer(1, "premium", 3)))
    run(store, root, maxFilesPerTrigger=2)
    expected = spark.createDataFrame([(k,) for k in (1, *range(10, 15))], "id bigint")
    assert missing_ids(expected, store.raw(CUSTOMERS).select(raw_key(CUSTOMERS).alias("id")), "id").count() == 0
    assert ids(store) == [1, 1, 10, 11, 12, 13, 14]
    assert rows(store.typed(CUSTOMERS).filter("id = 1"), "status") == [("premium",)]
    # The same content delivered under another name: raw repeats it, typed does not change.
    before = rows(store.typed(CUSTOMERS), "id", "status", "updated_at")
    write_file(root, f"{STAGE}/two-again.json", lines(customer(1, "premium", 3)))
    run(store, root)
    assert len(ids(store)) == 8 and rows(store.typed(CUSTOMERS), "id", "status", "updated_at") == before


def test_reset_loads_everything_again(spark, root):
    store = Store(spark, root)
    write_file(root, f"{STAGE}/one.json", lines(customer(1, "active", 1), customer(2, "active", 1)))
    run(store, root)
    before = rows(store.typed(CUSTOMERS), "id", "status", "updated_at", "created_at")
    reset_stream(store, CUSTOMERS)
    run(store, root)
    assert ids(store) == [1, 1, 2, 2]
    assert rows(store.typed(CUSTOMERS), "id", "status", "updated_at", "created_at") == before


def test_abort_writes_nothing(spark, root):
    store = Store(spark, root)
    write_file(root, f"{STAGE}/one.json", lines(customer(1, "active", 1)) + "broken\n")
    with pytest.raises(Exception, match="malformed"):
        run(store, root, options=LoadOptions(on_error="abort"))
    assert store.raw(CUSTOMERS).count() == 0 and store.typed(CUSTOMERS).count() == 0
    with pytest.raises(ValueError):
        batch = read_stage(spark, root, "postgres_cdc", "customers")
        load_batch(store, CUSTOMERS, batch, 0, LoadOptions(on_error="guess"))
    with pytest.raises(BadRecords):
        load_batch(store, CUSTOMERS, batch, 0, LoadOptions(on_error="abort"))


def test_bad_values_fail_the_load_or_are_set_aside(spark, root):
    store = Store(spark, root)
    bad = {"id": 2, "status": "active", "updated_at": "yesterday"}
    write_file(root, f"{STAGE}/one.json", lines(customer(1, "active", 1), bad))
    with pytest.raises(Exception, match="CAST"):
        run(store, root)
    assert store.typed(CUSTOMERS).count() == 0
    run(store, root, options=LoadOptions(on_bad="quarantine"))
    assert rows(store.typed(CUSTOMERS), "id") == [(1,)] and ids(store) == [1, 2]
    (error,) = store.errors(CUSTOMERS).collect()
    assert error.reason == "bad value: updated_at" and json.loads(error.line) == bad and error.step == "cast"


def test_repeating_a_load_changes_nothing(spark, root):
    store = Store(spark, root)
    write_file(root, f"{STAGE}/one.json", lines(customer(1, "active", 1), customer(2, "active", 1)) + "broken\n")
    batch = read_stage(spark, root, "postgres_cdc", "customers")
    for _ in range(2):
        load_batch(store, CUSTOMERS, batch, 5000, LoadOptions(load_ts=at(9)))
        assert ids(store) == [1, 2] and store.errors(CUSTOMERS).count() == 1 and store.audit(CUSTOMERS).count() == 1
        assert rows(store.typed(CUSTOMERS), "id", "_etl_loaded_at") == [(1, at(9)), (2, at(9))]


def test_compaction_keeps_the_table(spark, root):
    store = Store(spark, root)
    loads = [[customer(1, "a", 1), customer(2, "a", 1)], [customer(2, "b", 2), customer(3, "a", 2)], [customer(1, "late", 0, created=9)]]
    for n, records in enumerate(loads):
        write_file(root, f"{STAGE}/{n}.json", lines(*records))
        run(store, root, options=LoadOptions(load_ts=at(n)))
    before = rows(store.typed(CUSTOMERS), *CUSTOMERS.typed_columns)
    assert [r[:2] for r in rows(store.typed(CUSTOMERS), "id", "status")] == [(1, "a"), (2, "b"), (3, "a")]
    # A base that was begun but never marked as finished is not read.
    spark.createDataFrame([], CUSTOMERS.typed_schema).write.parquet(f"{store.base_path(CUSTOMERS)}/v=2")
    assert rows(store.typed(CUSTOMERS), *CUSTOMERS.typed_columns) == before
    assert store.compact(CUSTOMERS) == 2 and rows(store.typed(CUSTOMERS), *CUSTOMERS.typed_columns) == before
    assert store.compact(CUSTOMERS) == 2
    # The load behind the base repeated after a crash is already in it; its changes come again under id 3.
    batch = read_stage(spark, root, "postgres_cdc", "customers").filter(F.col("_source_file").contains("/2.json"))
    load_batch(store, CUSTOMERS, batch, 2, LoadOptions(load_ts=at(2)))
    assert rows(store.typed(CUSTOMERS), *CUSTOMERS.typed_columns) == before
    write_file(root, f"{STAGE}/3.json", lines(customer(3, "b", 3), customer(4, "a", 3)))
    run(store, root, options=LoadOptions(load_ts=at(3)))
    expected = [(1, "a"), (2, "b"), (3, "b"), (4, "a")]
    assert rows(store.typed(CUSTOMERS), "id", "status") == expected and store.compact(CUSTOMERS) == 4
    assert rows(store.typed(CUSTOMERS), "id", "status") == expected


def test_writers_in_turn_keep_each_others_loads(spark, root):
    store = Store(spark, root)
    write_file(root, f"{STAGE}/one.json", lines(customer(1, "a", 1), customer(2, "a", 1)))
    run(store, root)
    polled = typed(raw_customers(spark, [(customer(9, "a", 1),)]), CUSTOMERS).select("id", "status", "updated_at")
    pull_once(store, CUSTOMERS, polled, "updated_at")
    assert ids(store) == [1, 2, 9] and rows(store.typed(CUSTOMERS), "id") == [(1,), (2,), (9,)]
    merge_cdc_batch(store, "customers")
    store.compact(CUSTOMERS)
    pull_once(store, CUSTOMERS, polled.withColumn("id", F.lit(10).cast("long")).withColumn("updated_at", F.lit(at(2))), "updated_at")
    write_file(root, f"{STAGE}/two.json", lines(customer(2, "b", 3)))
    run(store, root)
    assert ids(store) == [1, 2, 2, 9, 10]
    assert rows(store.typed(CUSTOMERS), "id", "status") == [(1, "a"), (10, "a"), (2, "b"), (9, "a")]


def test_a_crashed_load_survives_merge_and_compaction(spark, root, monkeypatch):
    store = Store(spark, root)
    write_file(root, f"{STAGE}/one.json", lines(customer(1, "a", 1)))
    run(store, root)
    write_file(root, f"{STAGE}/two.json", lines(customer(2, "a", 2)))

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr("millrace.streaming.loader.merge_load", crash)
        with pytest.raises(Exception, match="lost"):
            run(store, root)
    merge_cdc_batch(store, "customers", "another")
    store.compact(CUSTOMERS)
    assert ids(store) == [1, 2] and rows(store.typed(CUSTOMERS), "id") == [(1,)]
    run(store, root)
    assert ids(store) == [1, 2] and rows(store.typed(CUSTOMERS), "id") == [(1,), (2,)]
    store.compact(CUSTOMERS)
    assert rows(store.typed(CUSTOMERS), "id") == [(1,), (2,)]


def test_more_merges_by_hand_than_ever_counted(spark, root):
    store = Store(spark, root)
    taken = [store.load_id(CUSTOMERS, "hand", str(n)) for n in range(1001)]
    assert taken == list(range(1001)) and store.load_id(CUSTOMERS, "hand", "1000") == 1000


def test_pruning_keeps_what_is_read(spark, root):
    store = Store(spark, root)
    for n in range(4):
        raw = raw_customers(spark, [(customer(n, "a", n),), (customer(9, f"s{n}", n),)])
        store.write_landed(raw, CUSTOMERS, n * 1000)
        merge_load(store, CUSTOMERS, store.raw(CUSTOMERS, n * 1000), n * 1000, LoadOptions(), at(n))
        if n < 3:
            store.compact(CUSTOMERS)
    before = rows(store.typed(CUSTOMERS), *CUSTOMERS.typed_columns)
    assert [r[:2] for r in rows(store.typed(CUSTOMERS), "id", "status")] == [(0, "a"), (1, "a"), (2, "a"), (3, "a"), (9, "s3")]
    assert store.prune(CUSTOMERS) == [0]
    assert store.prune(CUSTOMERS) == [] and store.prune(CUSTOMERS, keep=1) == [1000]
    assert rows(store.typed(CUSTOMERS), *CUSTOMERS.typed_columns) == before
    with pytest.raises(ValueError):
        store.prune(CUSTOMERS, keep=0)


def test_old_loaded_files_are_named(spark, root):
    store = Store(spark, root)
    write_file(root, "staged/postgres_cdc/customers/2024/01/02/a.json", lines(customer(1, "a", 1)))
    write_file(root, "staged/postgres_cdc/customers/2024/01/09/b.json", lines(customer(2, "a", 1)))
    run(store, root)
    write_file(root, "staged/postgres_cdc/customers/2024/01/03/late.json", lines(customer(3, "a", 1)))
    files = list_files(spark, stage_path(root, "postgres_cdc", "customers"))
    files = files.withColumn("dt", file_day(F.col("file")))
    audit = store.audit(CUSTOMERS)
    assert [r.file.rsplit("/", 1)[1] for r in new_files(files, audit).collect()] == ["late.json"]
    old = expired_files(files, audit, "2024-01-10 00:00:00").collect()
    assert [r.file.rsplit("/", 1)[1] for r in old] == ["a.json"]


def test_days_in_paths(spark):
    paths = ["s/c/2024/01/02/x.json", "s/c/2024-01-02/x.json", "s/c/y=2024/m=01/d=02/x.json", "s/c/dt=2024-01-02/x.json", "s/c/2024/13/99/x", "s/c/x.json"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string").select("i", file_day(F.col("p")).alias("d"))
    assert [r.d for r in df.orderBy("i").collect()] == [dt.date(2024, 1, 2)] * 4 + [None, None]


def test_change_log_stream(spark, root):
    spec = CUSTOMERS.as_changelog()
    store = Store(spark, root)

    def event(op, hours, **data):
        return {"op": op, "ts": at(hours).isoformat(), **data}

    write_file(
        root,
        f"{STAGE}/0.json",
        lines(
            event("insert", 1, **customer(1, "active", 1, created=1)),
            event("INSERT", 1, **customer(2, "active", 1, created=1)),
            event("TRUNCATE", 1, id=3),
        ),
    )
    run(store, root, spec)
    write_file(root, f"{STAGE}/1.json", lines(event("DELETE", 2, id=1), event("UPDATE", 2, **customer(2, "premium", 2, created=2))))
    run(store, root, spec)
    expected = [(1, "active", True, at(1), "DELETE"), (2, "premium", False, at(1), "UPDATE")]
    columns = ("id", "status", "is_deleted", "created_at", "_cdc_operation")
    assert rows(store.typed(spec), *columns) == expected
    assert [r.reason for r in store.errors(spec).collect()] == ["unknown operation"]
    store.compact(spec)
    write_file(root, f"{STAGE}/2.json", lines(event("UPDATE", 3, **customer(1, "back", 3, created=3))))
    run(store, root, spec)
    assert rows(store.typed(spec), *columns)[0] == (1, "back", False, at(1), "UPDATE")


def test_accounts_and_orders_load_too(spark, root):
    store = Store(spark, root)
    account = {"Id": "001000000000000AAA", "Name": "Acme", "AnnualRevenue": 1234.5, "IsDeleted": False, "LastModifiedDate": "2024-01-02T00:00:00.000+0000"}
    write_file(root, "staged/salesforce/accounts/2024-01-02/a.json", json.dumps([account]))
    order = {"id": 70, "customer_id": 7, "order_date": "2024-01-02", "total_amount": 99.99, "currency": "GBP", "updated_at": "2024-01-02T00:00:00"}
    write_file(root, "staged/postgres_cdc/orders/2024/01/02/o.json", lines(order))
    run(store, root, ACCOUNTS)
    run(store, root, ORDERS)
    row = store.typed(ACCOUNTS).first()
    assert row.name == "Acme" and str(row.annual_revenue) == "1234.50" and row.last_modified_date == dt.datetime(2024, 1, 2)
    assert "_cdc_operation" not in store.raw(ACCOUNTS).columns
    assert str(store.typed(ORDERS).first().total_amount) == "99.99"


def test_stage_layouts(spark, root):
    df = spark.createDataFrame([(1, at(0)), (2, at(30)), (3, at(31))], "id int, changed timestamp_ntz")
    path = write_stage(df, root, "postgres_cdc", "customers", "changed")
    files = [r.file for r in list_files(spark, path).collect()]
    assert sorted("/".join(f.split("/")[-4:-1]) for f in files) == ["y=2024/m=01/d=01", "y=2024/m=01/d=02"]
    path = write_stage(df, root, "salesforce", "contacts", "changed", LAYOUT_DAY, max_records=1)
    files = [r.file for r in list_files(spark, path).collect()]
    assert sorted(f.split("/")[-2] for f in files) == ["dt=2024-01-01", "dt=2024-01-02", "dt=2024-01-02"]
    got = read_stage(spark, root, "salesforce", "contacts").select(F.parse_json("value").alias("v"))
    assert got.filter("variant_get(v, '$.changed', 'timestamp_ntz') = timestamp_ntz '2024-01-02 06:00:00'").count() == 1
    with pytest.raises(ValueError):
        write_stage(df, root, "a", "b", "changed", "weekly")
    assert stage_path("/x/", "f", "t") == "/x/staged/f/t/"


def source(spark, *records):
    data = [(k, s, at(h), at(h)) for k, s, h in records]
    return spark.createDataFrame(data, "id bigint, status string, created_at timestamp_ntz, updated_at timestamp_ntz")


def test_polls_read_past_the_mark(spark, root):
    store = Store(spark, root)
    table = source(spark, (1, "active", 1), (2, "active", 2))
    assert pull_once(store, CUSTOMERS, table, "updated_at") == at(2)
    assert pull_once(store, CUSTOMERS, table, "updated_at") is None
    table = table.unionByName(source(spark, (1, "premium", 3)))
    assert pull_once(store, CUSTOMERS, table, "updated_at") == at(3)
    assert ids(store) == [1, 1, 2]
    assert rows(store.typed(CUSTOMERS), "id", "status", "created_at") == [(1, "premium", at(1)), (2, "active", at(2))]
    # A row committed late behind the mark needs the overlap; the repeats do no harm.
    table = table.unionByName(source(spark, (3, "late", 2)))
    assert pull_once(store, CUSTOMERS, table, "updated_at") is None
    assert pull_once(store, CUSTOMERS, table, "updated_at", dt.timedelta(hours=2)) == at(3)
    assert [r[0] for r in rows(store.typed(CUSTOMERS), "id")] == [1, 2, 3]
    reset_pull(store, CUSTOMERS)
    assert pull_once(store, CUSTOMERS, table, "updated_at") == at(3)
    assert len(rows(store.typed(CUSTOMERS), "id")) == 3
    assert {r.status for r in store.audit(CUSTOMERS).collect()} == {"Loaded"}


def test_an_unfinished_poll_is_repeated_under_its_id(spark, root, monkeypatch):
    store = Store(spark, root)
    table = source(spark, (1, "active", 1))
    monkeypatch.setattr(PullState, "advance", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        pull_once(store, CUSTOMERS, table, "updated_at")
    monkeypatch.undo()
    pull_once(store, CUSTOMERS, table, "updated_at")
    assert ids(store) == [1]


def test_mark_survives_one_lost_slot_and_never_goes_back(spark, root):
    state = PullState(spark, root)
    assert state.get("f")["hwm"] is None
    state.advance("f", at(5), "a")
    state.advance("f", at(3), "b")
    assert state.get("f")["hwm"] == at(5) and state.get("f")["batch_id"] == "b"
    state.advance("f", None, "c")
    assert state.get("f")["hwm"] == at(5)
    state.reset("f")
    assert state.get("f")["hwm"] is None and state.get("f")["generation"] == 1
    assert state.get("other")["seq"] == 0


def test_pull_filter_reaches_the_scan(spark, root):
    source(spark, (1, "a", 1), (2, "b", 2)).write.parquet(f"{root}/t")
    table = read_table(spark, "parquet", f"{root}/t")
    pulled = incremental_pull(table, "updated_at", at(1))
    assert "PushedFilters: [IsNotNull(updated_at), GreaterThan(updated_at" in pulled._jdf.queryExecution().executedPlan().toString()
    assert pulled.count() == 1 and next_hwm(pulled, F.col("updated_at")) == at(2)
    assert next_hwm(table.filter("id > 9"), "updated_at") is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_marks_do_not_depend_on_the_session_zone(spark, root, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        table = source(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3))
        assert rows(incremental_pull(table, "updated_at", at(2)), "id") == [(3,)]
        zoned = table.withColumn("updated_at", F.col("updated_at").cast("timestamp"))
        mark = next_hwm(zoned.filter("id < 3"), "updated_at")
        assert mark == at(2) and rows(incremental_pull(zoned, "updated_at", mark), "id") == [(3,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_object_pull_keeps_records_without_an_age(spark):
    raw = raw_customers(spark, [({"Id": "a", "LastModifiedDate": "2024-01-01T05:00:00.000+0000"},), ({"Id": "b"},), ({"Id": "c", "LastModifiedDate": "2024-01-01T02:00:00.000+0000"},)])
    field = CONTACTS.field("last_modified_date")
    got = object_pull(raw, field, at(3)).select(F.variant_get("_raw_json", "$.Id", "string")).collect()
    assert sorted(r[0] for r in got) == ["a", "b"]
    assert object_pull(raw, field).count() == 3


def test_procedure(spark, root):
    store = Store(spark, root)
    assert merge_cdc_batch(store, "invoices", "b1") == "ERROR: unknown table invoices"
    for n, status in enumerate(["active", "premium"]):
        raw = raw_customers(spark, [(customer(1, status, n),), (customer(n + 2, status, n),)], batch=f"b{n}")
        store.write_landed(raw, CUSTOMERS, n * 1000)
    assert merge_cdc_batch(store, "customers", "b1") == "OK: merged batch b1 for table customers"
    assert rows(store.typed(CUSTOMERS), "id", "status") == [(1, "premium"), (3, "premium")]
    assert merge_cdc_batch(store, "customers") == "OK: merged batch all for table customers"
    expected = [(1, "premium"), (2, "active"), (3, "premium")]
    assert rows(store.typed(CUSTOMERS), "id", "status") == expected
    assert merge_cdc_batch(store, "customers", "b0").startswith("OK")
    assert rows(store.typed(CUSTOMERS), "id", "status") == expected


def test_raw_values_are_pruned_to_the_paths_read(spark, root):
    store = Store(spark, root)
    store.write_landed(raw_customers(spark, [(customer(1, "a", 1),)]), CUSTOMERS, 0)
    found = store.raw(CUSTOMERS).filter((raw_key(CUSTOMERS) == 1) & (F.col(LOAD_ID) == 0)).select(raw_key(CUSTOMERS))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_raw_json:struct<0:bigint>>" in text and "isnotnull(_load_id" in text.split("PartitionFilters: ")[1]
    assert typed(store.raw(CUSTOMERS).drop(LOAD_ID), CUSTOMERS).count() == 1


def test_a_running_stream_picks_up_new_files(spark, root):
    store = Store(spark, root)
    write_file(root, f"{STAGE}/1.json", lines(customer(1, "active", 1)))
    query = start_stream(store, root, CUSTOMERS, {"processingTime": "1 second"}, maxFilesPerTrigger=1)
    try:
        query.processAllAvailable()
        assert ids(store) == [1]
        for k in (2, 3):
            write_file(root, f"{STAGE}/{k}.json", lines(customer(k, "active", 1)))
        query.processAllAvailable()
        assert ids(store) == [1, 2, 3]
        assert store.audit(CUSTOMERS).select(LOAD_ID).distinct().count() == 3
    finally:
        query.stop()


def test_a_thousand_rows_from_ten_writers_arrive(spark, root):
    store = Store(spark, root)
    for writer in range(10):
        records = [customer(writer * 100 + i, "active", 1) for i in range(100)]
        write_file(root, f"{STAGE}/{writer}.json", json.dumps(records) if writer % 2 else lines(*records))
    start = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0) - dt.timedelta(seconds=1)
    run(store, root, maxFilesPerTrigger=4)
    end = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0) + dt.timedelta(seconds=1)
    expected = spark.range(1000)
    landed = store.raw(CUSTOMERS).select(raw_key(CUSTOMERS).alias("id"))
    share = completeness(expected, landed, "id").first()
    assert share.ratio == 1.0 and share.is_complete
    rate = throughput(store.audit(CUSTOMERS), start, end).first()
    assert rate.n_rows == 1000 and rate.rows_per_second > 10
    assert store.typed(CUSTOMERS).count() == 1000
