"""How records lie in the raw area: one pass, real key columns, folded days, and a history that tells of failures."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import at, customer, plan, raw_customers, rows, write_file
from millrace import storage
from millrace.functions.records import NO_CHANGE_TIME
from millrace.operators.checks import column_conformance, raw_in_list, raw_point_lookup
from millrace.operators.files import expired_files, file_day, load_errors, new_files
from millrace.plans import feeds
from millrace.plans.procedure import merge_cdc_batch
from millrace.sources.stage import list_files, read_stage, stage_path, write_stage
from millrace.specs import CUSTOMERS, LOAD_ID, RAW_KEY
from millrace.storage import DAY, Store
from millrace.streaming.loader import LoadOptions, copy_into_raw, load_batch, maintain, merge_load, start_stream

STAGE = "staged/postgres_cdc/customers/2024/01/02"
NOW = {"availableNow": True}


def lines(*records):
    return "\n".join(json.dumps(r) for r in records) + "\n"


def run(store, root, spec=CUSTOMERS, options=LoadOptions(), **kw):
    start_stream(store, root, spec, NOW, options, **kw).awaitTermination()


def names(df):
    return sorted(r.file.rsplit("/", 1)[1] for r in df.collect())


def land(spark, store, load_id, records, day=0):
    raw = raw_customers(spark, [(r,) for r in records], loaded=24 * day, batch=f"b{load_id}")
    store.write_landed(raw, CUSTOMERS, load_id)


# -- one pass --------------------------------------------------------------------


def test_lines_are_read_once_although_some_are_bad(spark, root):
    store = Store(spark, root)
    write_file(root, f"{STAGE}/one.json", lines(customer(1, "a", 1)) + "broken\n" + lines(customer(2, "a", 1)) + "[1]\n")
    read = spark.sparkContext.accumulator(0)
    spark.udf.register("counted_line", lambda v: (read.add(1), v)[1])
    batch = read_stage(spark, root, "postgres_cdc", "customers").withColumn("value", F.expr("counted_line(value)"))
    copy_into_raw(store, CUSTOMERS, batch, 0, LoadOptions(), at(1))
    assert read.value == 4
    assert rows(store.raw(CUSTOMERS), RAW_KEY) == [(1,), (2,)]
    assert rows(store.errors(CUSTOMERS), "line", "reason") == [("1", "not an object"), ("broken", "malformed")]


def test_a_refused_item_does_not_bring_its_array(spark, root):
    store = Store(spark, root)
    write_file(root, f"{STAGE}/one.json", json.dumps([customer(1, "a", 1), 17, "x", customer(2, "a", 1)]) + "\n")
    run(store, root)
    assert rows(store.errors(CUSTOMERS), "line") == [('"x"',), ("17",)] and rows(store.raw(CUSTOMERS), RAW_KEY) == [(1,), (2,)]


# -- skipping --------------------------------------------------------------------


def scanned_rows(df):
    """Rows that the scans of a plan gave to what is above them."""
    df.collect()
    found, stack = 0, [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        stack += [node.children().apply(k) for k in range(node.children().size())]
    return found


def test_a_lookup_skips_row_groups(spark, root):
    store = Store(spark, root)
    for n in range(3):
        raw = spark.range(20_000).select(
            F.to_variant_object(F.struct((F.col("id") * 7 + n).alias("id"), F.lit(at(n)).cast("timestamp_ntz").alias("updated_at"))).alias("_raw_json"),
            F.lit("UPSERT").alias("_cdc_operation"), F.lit(at(n)).cast("timestamp_ntz").alias("_cdc_timestamp"),
            F.lit(at(n)).cast("timestamp_ntz").alias("_loaded_at"), F.lit("f").alias("_source_file"), F.lit(f"b{n}").alias("_batch_id"),
            F.expr("named_struct('block', 0L, 'line', id, 'item', 0)").alias("_record_pos"),
        )
        store.write_landed(raw, CUSTOMERS, n)
    found = raw_point_lookup(store.raw(CUSTOMERS), CUSTOMERS, 7 * 333 + 1)
    text = plan(found)
    assert f"EqualTo({RAW_KEY},2332)" in text.split("PushedFilters")[1]
    assert found.count() == 1
    # two loads have no such key: their bloom filters say so although their ranges hold it
    assert scanned_rows(found) <= 20_000 / 4 + 1
    assert store.fold_days(CUSTOMERS, "2024-01-02", file_bytes=folder_part(store, 8)) == [0, 1, 2]
    found = raw_point_lookup(store.raw(CUSTOMERS), CUSTOMERS, 7 * 333 + 1)
    assert found.count() == 1 and scanned_rows(found) <= 60_000 / 4
    listed = raw_in_list(store.raw(CUSTOMERS), CUSTOMERS, [7, 14, 10**9])
    assert f"In({RAW_KEY}" in plan(listed).split("PushedFilters")[1] and listed.count() == 2
    # the record itself is not read for its key
    assert "_raw_json" not in plan(store.raw(CUSTOMERS).select(RAW_KEY)).split("ReadSchema")[1].split("\n")[0]


def folder_part(store, parts):
    size = sum(os.path.getsize(os.path.join(d, n)) for d, _, ns in os.walk(store.raw_path(CUSTOMERS)) for n in ns)
    return size // parts


# -- days ------------------------------------------------------------------------


def raw_files(store, kind=".parquet"):
    return [os.path.join(d, n) for top in (store.raw_path(CUSTOMERS), f"{store.days_path(CUSTOMERS)}/rows") for d, _, ns in os.walk(top) for n in ns if n.endswith(kind)]


def test_many_loads_of_a_day_become_a_few_files(spark, root):
    store = Store(spark, root)
    # two thousand minute loads: one is written, the others are its folder again under their ids
    land(spark, store, 0, [customer(k, "a", 1) for k in range(3)])
    loads = spark.range(2000, numPartitions=1)
    first = spark.read.parquet(f"{store.raw_path(CUSTOMERS)}/{LOAD_ID}=0")
    first.crossJoin(loads.filter("id > 0").withColumnRenamed("id", LOAD_ID)).repartition(LOAD_ID).write.mode("append").partitionBy(LOAD_ID, "_outcome").parquet(store.raw_path(CUSTOMERS))
    land(spark, store, 2000, [customer(9, "next day", 30)], day=1)
    before = rows(store.raw(CUSTOMERS), LOAD_ID, RAW_KEY)
    assert len(before) == 6001 and len(raw_files(store)) > 2000
    assert store.fold_days(CUSTOMERS, "2024-01-02") == list(range(2000))
    assert len(raw_files(store)) <= 6
    assert rows(store.raw(CUSTOMERS), LOAD_ID, RAW_KEY) == before
    assert rows(store.raw(CUSTOMERS, 77), RAW_KEY) == [(0,), (1,), (2,)]
    assert store.fold_days(CUSTOMERS, "2024-01-02") == []
    assert store.load_id(CUSTOMERS, "stream", "0/0") == 2001


def test_days_expire_by_folder(spark, root):
    store = Store(spark, root)
    for day in range(4):
        land(spark, store, day, [customer(day, "a", 1)], day=day)
    store.fold_days(CUSTOMERS, "2024-01-04")
    assert rows(store.raw(CUSTOMERS), RAW_KEY) == [(0,), (1,), (2,), (3,)]
    assert "PartitionFilters: [" in plan(store._days(CUSTOMERS, store._folds(CUSTOMERS)).filter(F.col(DAY) == "2024-01-02"))
    assert store.expire_days(CUSTOMERS, "2024-01-03") == ["2024-01-01", "2024-01-02"]
    assert rows(store.raw(CUSTOMERS), RAW_KEY) == [(2,), (3,)]
    assert store.expire_days(CUSTOMERS, "2024-01-03") == []


@pytest.mark.parametrize("where", ["write", "mark", "remove"])
def test_a_fold_that_stops_anywhere_loses_and_repeats_nothing(spark, root, monkeypatch, where):
    store = Store(spark, root)
    for n in range(3):
        land(spark, store, n, [customer(n, "a", 1), customer(n + 10, "a", 1)])
    write_file(root, f"{STAGE}/bad.json", "broken\n")
    load_batch(store, CUSTOMERS, read_stage(spark, root, "postgres_cdc", "customers"), 3, LoadOptions(load_ts=at(2)))
    before, refused = rows(store.raw(CUSTOMERS), LOAD_ID, RAW_KEY), rows(store.errors(CUSTOMERS), "line", "step")

    def lost(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        if where == "remove":
            broken.setattr("millrace.storage.remove_folder", lost)
        elif where == "mark":
            broken.setattr(Store, "_marks_path", lambda *_: lost() if any(f.function == "fold_days" for f in __import__("inspect").stack()[1:3]) and os.path.exists(f"{store.days_path(CUSTOMERS)}/rows") else f"{store.days_path(CUSTOMERS)}/folds")
        else:
            broken.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", lost)
        with pytest.raises(RuntimeError):
            store.fold_days(CUSTOMERS, "2024-01-02")
    for _ in range(2):
        assert rows(store.raw(CUSTOMERS), LOAD_ID, RAW_KEY) == before
        assert rows(store.errors(CUSTOMERS), "line", "step") == refused == [("broken", "parse")]
        store.fold_days(CUSTOMERS, "2024-01-02")
    assert not [n for n in os.listdir(store.raw_path(CUSTOMERS)) if n.startswith(LOAD_ID)]
    # a load that is repeated after its day was folded
    land(spark, store, 1, [customer(1, "a", 1), customer(11, "a", 1)])
    assert rows(store.raw(CUSTOMERS), LOAD_ID, RAW_KEY) == before and rows(store.raw(CUSTOMERS, 1), RAW_KEY) == [(1,), (11,)]


def test_errors_go_after_their_time(spark, root):
    store = Store(spark, root)
    write_file(root, f"{STAGE}/bad.json", "broken\n" + lines({"id": 1, "updated_at": "yesterday"}))
    batch = read_stage(spark, root, "postgres_cdc", "customers")
    for n, day in enumerate((0, 20)):
        load_batch(store, CUSTOMERS, batch, n, LoadOptions(on_bad="quarantine", load_ts=at(24 * day)))
    store.fold_days(CUSTOMERS, "2024-02-20")
    assert rows(store.errors(CUSTOMERS), "dt", "step") == sorted([(dt.date(2024, 1, d), s) for d in (1, 21) for s in ("parse", "cast")], key=repr)
    assert store.expire_errors(CUSTOMERS, "2024-02-01 10:00:00") == ["2024-01-01"]
    assert rows(store.errors(CUSTOMERS), "dt", "step") == [(dt.date(2024, 1, 21), "cast"), (dt.date(2024, 1, 21), "parse")]


# -- history ---------------------------------------------------------------------


def test_files_without_records_are_in_the_history(spark, root):
    store = Store(spark, root)
    write_file(root, f"{STAGE}/one.json", lines(customer(1, "a", 1)))
    write_file(root, f"{STAGE}/empty.json", "")
    write_file(root, f"{STAGE}/blank line.json", "\n \n")
    write_file(root, f"{STAGE}/none.json", "[]\n")
    run(store, root, maxFilesPerTrigger=3)
    counts = {r.file.rsplit("/", 1)[1]: (r.status, r.row_parsed, r.row_count, r.error_count) for r in store.audit(CUSTOMERS).collect()}
    nothing = ("Loaded", 0, 0, 0)
    assert counts == {"one.json": ("Loaded", 1, 1, 0), "empty.json": nothing, "blank%20line.json": nothing, "none.json": nothing}
    write_file(root, f"{STAGE}/two.json", "")
    files = list_files(spark, stage_path(root, "postgres_cdc", "customers"))
    assert names(new_files(files, store.audit(CUSTOMERS))) == ["two.json"]
    old = expired_files(files.withColumn("dt", file_day(F.col("file"))), store.audit(CUSTOMERS), "2024-02-01 00:00:00")
    assert names(old) == sorted(counts)


def test_many_micro_batches_list_their_files(spark, root):
    store = Store(spark, root)
    for k in range(23):
        write_file(root, f"{STAGE}/{k}.json", lines(customer(k, "a", 1)) if k % 2 else "")
    run(store, root, options=LoadOptions(merge=False), maxFilesPerTrigger=1)
    found = store.audit(CUSTOMERS).groupBy("file").agg(F.count("*").alias("n"), F.sum("row_count").alias("r")).collect()
    assert {int(r.file.rsplit("/", 1)[1][:-5]): (r.n, r.r) for r in found} == {k: (1, k % 2) for k in range(23)}


def test_failed_tries_leave_a_trace(spark, root):
    store = Store(spark, root)
    write_file(root, f"{STAGE}/one.json", lines(customer(1, "active", 1)) + "broken\n")
    with pytest.raises(Exception, match="malformed"):
        run(store, root, options=LoadOptions(on_error="abort"))
    assert store.raw(CUSTOMERS).count() == 0
    (row,) = store.audit(CUSTOMERS).collect()
    assert (row.query_type, row.status, row.row_parsed, row.row_count) == ("COPY", "Load failed", None, 0)
    assert row.file.endswith("/one.json") and row.error_message == f"{row.file}: malformed"
    files = list_files(spark, stage_path(root, "postgres_cdc", "customers"))
    assert names(new_files(files, store.audit(CUSTOMERS))) == ["one.json"]
    assert load_errors(store.audit(CUSTOMERS), "dev").count() == 1
    run(store, root)
    # the load came right; the try before it stays in the history
    assert rows(store.audit(CUSTOMERS), "status", "row_parsed") == [("Load failed", None), ("Partially loaded", 2)]
    assert names(new_files(files, store.audit(CUSTOMERS))) == []
    write_file(root, f"{STAGE}/two.json", lines({"id": 2, "updated_at": "yesterday"}))
    with pytest.raises(Exception, match="CAST"):
        run(store, root)
    failed = store.audit(CUSTOMERS).filter("query_type = 'MERGE'").first()
    assert failed.status == "Load failed" and "CAST" in failed.error_message and failed.file.endswith("two.json")


# -- refusals --------------------------------------------------------------------


def test_long_strings_are_set_aside_unless_cutting_is_asked_for(spark, root):
    write_file(root, f"{STAGE}/one.json", lines(customer(1, "s" * 21, 1, first_name="x" * 101), customer(2, "ok", 1)))
    store = Store(spark, f"{root}/aside")
    run(store, root)
    assert rows(store.typed(CUSTOMERS), "id") == [(2,)]
    (error,) = store.errors(CUSTOMERS).collect()
    assert (error.step, error.reason) == ("cast", "bad value: first_name, status") and json.loads(error.line)["id"] == 1
    store = Store(spark, f"{root}/cut")
    run(store, root, options=LoadOptions(on_long="truncate"))
    assert rows(store.typed(CUSTOMERS), "id", "status", "first_name") == [(1, "s" * 20, "x" * 100), (2, "ok", None)]
    (error,) = store.errors(CUSTOMERS).collect()
    assert (error.step, error.reason) == ("cut", "cut: first_name, status")
    # repeated with nothing to tell, the list is empty again
    merge_load(store, CUSTOMERS, store.raw(CUSTOMERS).filter(F.col(RAW_KEY) == 2), 0, LoadOptions(), at(1))
    assert store.errors(CUSTOMERS).count() == 0


def test_changes_without_a_time_are_refused(spark, root):
    spec = CUSTOMERS.as_changelog()
    store = Store(spark, root)
    change = {"op": "INSERT", "ts": at(1).isoformat(), **customer(1, "a", 1)}
    write_file(root, f"{STAGE}/0.json", lines(change, {**change, "id": 2, "ts": None}, {**change, "id": 3, "ts": "soon"}, {"op": "DELETE", "id": 1}))
    run(store, root, spec)
    assert rows(store.typed(spec), "id", "is_deleted") == [(1, False)]
    assert [r.reason for r in store.errors(spec).collect()] == [NO_CHANGE_TIME] * 3


def test_the_procedure_treats_bad_values_as_asked(spark, root):
    store = Store(spark, root)
    land(spark, store, 0, [customer(1, "a", 1), {"id": 2, "updated_at": "yesterday"}])
    with pytest.raises(Exception, match="CAST"):
        merge_cdc_batch(store, "customers")
    assert merge_cdc_batch(store, "customers", None, LoadOptions(on_bad="quarantine")).startswith("OK")
    assert rows(store.typed(CUSTOMERS), "id") == [(1,)]
    assert [r.reason for r in store.errors(CUSTOMERS).collect()] == ["bad value: updated_at"]


# -- upkeep ----------------------------------------------------------------------


def test_upkeep_leaves_the_tables_as_they_are(spark, root):
    store = Store(spark, root, bucket_rows=2)
    for n, day in enumerate((0, 0, 1, 2)):
        write_file(root, f"{STAGE}/{n}.json", lines(customer(n, "a", n), customer(9, f"s{n}", n)) + "broken\n")
        batch = read_stage(spark, root, "postgres_cdc", "customers").filter(F.col("_source_file").endswith(f"/{n}.json"))
        load_batch(store, CUSTOMERS, batch, n, LoadOptions(load_ts=at(24 * day)))
    before = rows(store.typed(CUSTOMERS), *CUSTOMERS.typed_columns)
    history = rows(store.audit(CUSTOMERS), *store.audit(CUSTOMERS).columns)
    done = maintain(store, CUSTOMERS, "2024-01-03 05:00:00", raw_days=1, error_days=1)
    assert done == {"folded": [0, 1, 2], "base": 3, "pruned": [], "expired errors": ["2024-01-01"], "expired days": ["2024-01-01"]}
    assert rows(store.typed(CUSTOMERS), *CUSTOMERS.typed_columns) == before
    assert rows(store.raw(CUSTOMERS), RAW_KEY) == [(2,), (3,), (9,), (9,)] and store.errors(CUSTOMERS).count() == 2
    assert maintain(store, CUSTOMERS, "2024-01-03 05:00:00")["folded"] == []
    # the history is as it was, in two folders instead of four; each batch frame here names all files there were
    assert rows(store.audit(CUSTOMERS), *store.audit(CUSTOMERS).columns) == history and len(history) == 1 + 2 + 3 + 4
    assert [n for n in os.listdir(store.audit_path(CUSTOMERS)) if n.startswith(LOAD_ID)] == [f"{LOAD_ID}=3"]


def test_records_keep_fields_named_like_folders_and_their_microseconds(spark, root):
    moment = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    df = spark.createDataFrame([(1, "why", moment)], "id int, y string, changed timestamp_ntz")
    df = df.withColumn("zoned", F.col("changed").cast("timestamp"))
    path = write_stage(df, root, "postgres_cdc", "customers", "changed")
    (line,) = read_stage(spark, root, "postgres_cdc", "customers").collect()
    record = json.loads(line.value)
    assert record == {"id": 1, "y": "why", "changed": "2024-01-02T03:04:05.678901", "zoned": "2024-01-02T03:04:05.678901Z"}
    assert "/y=2024/m=01/d=02/" in line._source_file and path.endswith("/customers/")
    write_stage(df.drop("y"), root, "salesforce", "accounts", "changed")
    (line,) = read_stage(spark, root, "salesforce", "accounts").collect()
    assert json.loads(line.value)["zoned"] == "2024-01-02T03:04:05.678901Z"


def test_columns_of_a_table(spark):
    df = spark.createDataFrame([(1, "abc"), (None, "abcdef")], "a int, B string")
    expected = T.StructType().add("a", T.LongType()).add("b", T.StringType(), True, {"max_length": 4}).add("c", T.IntegerType())
    assert rows(column_conformance(df, expected), "column_name", "is_there", "has_type", "n_rows", "n_null", "n_long") == [
        ("a", True, False, 2, 1, 0), ("b", True, True, 2, 0, 1), ("c", False, False, 2, None, None)
    ]


def rows_of_files(df):
    return [r["count"] for r in df.groupBy(F.col("_metadata.file_path").alias("file")).count().collect()]


def test_no_task_of_a_fold_sorts_all_rows(spark, root, monkeypatch):
    monkeypatch.setattr(storage, "FOLDED_TASK_ROWS", 20)
    store, day = Store(spark, root), {"updated_at": "2024-01-01T00:00:00"}
    for n in range(3):
        land(spark, store, n, [{"id": k, **day} for k in range(40)])
    before = rows(store.raw(CUSTOMERS), "_key", LOAD_ID)
    assert store.fold_days(CUSTOMERS, "2024-01-02") == [0, 1, 2]
    assert rows(store.raw(CUSTOMERS), "_key", LOAD_ID) == before and len(before) == 120
    held = rows_of_files(spark.read.parquet(f"{store.days_path(CUSTOMERS)}/rows"))
    assert len(held) >= 5 and max(held) <= 40


def test_a_fold_spreads_many_refused_records(spark, root, monkeypatch):
    monkeypatch.setattr(storage, "FOLDED_TASK_ROWS", 20)
    store = Store(spark, root)
    write_file(root, f"{STAGE}/bad.json", "".join(f"{{{n}\n" for n in range(100)) + lines({"id": 1}))
    run(store, root, options=LoadOptions(merge=False, load_ts="2024-01-02 00:00:00"))
    before = rows(store.errors(CUSTOMERS), "line", "reason")
    assert store.fold_days(CUSTOMERS, "2024-02-01") == [0] and len(before) == 100
    assert rows(store.errors(CUSTOMERS), "line", "reason") == before
    held = rows_of_files(spark.read.parquet(f"{store.errors_path(CUSTOMERS)}/step=parse"))
    assert len(held) >= 4 and max(held) <= 50


def test_tables_are_spread_before_their_rows_are_records(spark, root, monkeypatch):
    spark.range(4000).coalesce(1).write.parquet(f"{root}/events.parquet")
    monkeypatch.setattr(feeds, "RECORD_BYTES", 1000)
    found = feeds.record_table(spark, root, "events")
    parts = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(parts) == 4000 and len(parts) >= 8 and max(parts) < 1000


def test_rows_that_take_few_bytes_are_spread_too(spark, root, monkeypatch):
    spark.range(40_000).select(F.col("id").alias("event_id"), F.lit(1).alias("n")).coalesce(1).write.parquet(f"{root}/events.parquet")
    monkeypatch.setattr(feeds, "RECORD_ROWS", 2000)
    found = feeds.record_table(spark, root, "events")
    parts = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(parts) == 40_000 and len(parts) >= 16 and max(parts) < 4000
