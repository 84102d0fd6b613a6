"""Polls whose marks are stream offsets, and bins that close when full or old."""

import datetime as dt
import decimal
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from millrace.plans import landing_queries
from millrace.sources.marks import packed_mark, unpacked_mark
from millrace.sources.polling import Piece, PollReader, read_polled
from millrace.specs import CUSTOMERS, LOAD_ID, RAW_KEY
from millrace.storage import Store
from millrace.streaming.bins import FULL, OLD, start_binning, stop_between_batches
from millrace.streaming.loader import LoadOptions, pull_once, reset_pull, start_poll

NOW = {"availableNow": True}


def grow(spark, path, *records):
    data = [(k, s, at(h), h) for k, s, h in records]
    df = spark.createDataFrame(data, "id bigint, status string, updated_at timestamp_ntz, version int")
    df.coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("mark", [None, 7, 2.5, "x", decimal.Decimal("1.10"), dt.datetime(2024, 1, 1, 2, 3, 4, 567), dt.date(2024, 1, 2)])
def test_marks_of_any_type_keep(mark):
    assert unpacked_mark(json.loads(json.dumps(packed_mark(mark)))) == mark


def test_marks_that_do_not_order_are_refused():
    with pytest.raises(TypeError):
        packed_mark([1])


@pytest.mark.parametrize("cursor", ["updated_at", "version"])
def test_polls_go_on_restart_and_start_over(spark, root, cursor):
    store, path = Store(spark, f"{root}/lake"), f"{root}/table"
    grow(spark, path, (1, "active", 1), (2, "active", 2))

    def poll():
        start_poll(store, CUSTOMERS, path, cursor, NOW).awaitTermination()

    poll()
    assert rows(store.typed(CUSTOMERS), "id", "status") == [(1, "active"), (2, "active")]
    poll()
    assert store.raw(CUSTOMERS).count() == 2
    grow(spark, path, (1, "premium", 3), (4, "late", 2))
    poll()
    # a row behind the mark is not seen
    assert rows(store.typed(CUSTOMERS), "id", "status") == [(1, "premium"), (2, "active")]
    assert store.raw(CUSTOMERS).select(LOAD_ID).distinct().count() == 2
    reset_pull(store, CUSTOMERS)
    poll()
    assert rows(store.typed(CUSTOMERS), "id", "status") == [(1, "premium"), (2, "active"), (4, "late")]
    assert store.raw(CUSTOMERS).count() == 2 + 1 + 4


def test_an_unfinished_poll_is_repeated_between_its_marks(spark, root, monkeypatch):
    store, path = Store(spark, f"{root}/lake"), f"{root}/table"
    grow(spark, path, (1, "active", 1))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr("millrace.streaming.loader.merge_load", lost)
        with pytest.raises(Exception, match="lost"):
            start_poll(store, CUSTOMERS, path, "updated_at", NOW).awaitTermination()
    assert store.raw(CUSTOMERS).count() == 1 and store.typed(CUSTOMERS).count() == 0
    grow(spark, path, (2, "active", 2))
    # the first poll again, up to its old mark, although there is more by now; then the rest
    for expected in ([(0, 1)], [(0, 1), (1, 2)]):
        start_poll(store, CUSTOMERS, path, "updated_at", NOW).awaitTermination()
        assert rows(store.raw(CUSTOMERS), LOAD_ID, RAW_KEY) == expected
    assert rows(store.typed(CUSTOMERS), "id") == [(1,), (2,)]
    assert rows(store.audit(CUSTOMERS), "status", "query_type") == [("Load failed", "MERGE"), ("Loaded", "COPY"), ("Loaded", "COPY")]


def test_only_row_groups_past_the_mark_are_read(spark, root):
    for n in range(4):
        grow(spark, f"{root}/t", *[(k, "a", 10 * n + k) for k in range(10)])
    reader = PollReader(f"{root}/t", "version", ["id", "version"])
    assert unpacked_mark(reader.latestOffset()) == 39
    pieces = reader.partitions(packed_mark(19), packed_mark(39))
    assert len(pieces) == 2 and all(isinstance(p, Piece) for p in pieces)
    found = [r for p in reader.partitions(packed_mark(24), packed_mark(31)) for b in reader.read(p) for r in b.column("version").to_pylist()]
    assert sorted(found) == list(range(25, 32))
    assert len(reader.partitions(packed_mark(None), packed_mark(39))) == 4
    assert reader.partitions(packed_mark(39), packed_mark(39)) == []


def test_rows_without_a_cursor_come_first_and_an_empty_table_has_no_mark(spark, root):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None)], "id bigint, version int")
    df.coalesce(1).write.parquet(f"{root}/t")
    df.filter("id = 1").coalesce(1).write.mode("append").parquet(f"{root}/t")
    seen = []
    read_polled(spark, f"{root}/t", "version").writeStream.foreachBatch(lambda b, i: seen.extend(r.id for r in b.collect())).option("checkpointLocation", f"{root}/c").trigger(**NOW).start().awaitTermination()
    assert sorted(seen) == [1, 1, 2, 3]
    df.filter("id > 9").write.parquet(f"{root}/none")
    assert unpacked_mark(PollReader(f"{root}/none", "version", ["id"]).latestOffset()) is None


def test_pulls_by_a_number_and_rows_without_a_cursor(spark, root):
    store = Store(spark, root)
    schema = "id bigint, status string, updated_at timestamp_ntz, version int"
    table = spark.createDataFrame([(1, "a", at(5), 1), (2, "a", at(4), 2), (3, "odd", None, None)], schema)
    # the mark is that of the column asked for, not of the one the table is merged by
    assert pull_once(store, CUSTOMERS, table, "version") == 2
    table = table.unionByName(spark.createDataFrame([(1, "b", at(6), 3)], schema))
    assert pull_once(store, CUSTOMERS, table, "version", 1) == 3
    assert rows(store.typed(CUSTOMERS), "id", "status") == [(1, "b"), (2, "a"), (3, "odd")]
    assert rows(store.raw(CUSTOMERS, 1), RAW_KEY) == [(1,), (2,), (3,)]


def test_a_change_log_has_folders_of_its_own(spark, root):
    store, path = Store(spark, f"{root}/lake"), f"{root}/table"
    grow(spark, path, (1, "active", 1))
    start_poll(store, CUSTOMERS, path, "version", NOW).awaitTermination()
    assert store.typed(CUSTOMERS).count() == 1 and store.typed(CUSTOMERS.as_changelog()).count() == 0


# -- bins ------------------------------------------------------------------------


def files_of(path):
    found = {}
    for folder, _, names in os.walk(f"{path}/files"):
        for n in names:
            if n.endswith(".txt"):
                with open(os.path.join(folder, n)) as f:
                    found.setdefault(folder.split("/files/")[1].split("/", 1)[1], []).append(f.read().splitlines())
    return found


def gather(spark, root, lines, n, age, wait, lanes=1):
    """Runs the bins until so many records are in files, or for a while."""
    stream = spark.readStream.schema("value string, kind string").option("maxFilesPerTrigger", 1).json(lines)
    query = start_binning(spark, stream, f"{root}/out", f"{root}/c", ["kind"], n, age, lanes, trigger={"processingTime": "200 milliseconds"})
    until = time.time() + 60
    try:
        while time.time() < until and sum(len(x) for f in files_of(f"{root}/out").values() for x in f) < wait:
            assert query.exception() is None
            time.sleep(0.3)
    finally:
        stop_between_batches(query)


def stage(root, name, records):
    os.makedirs(f"{root}/in", exist_ok=True)
    with open(f"{root}/in/.{name}", "w") as f:
        f.writelines(json.dumps({"value": v, "kind": k}) + "\n" for v, k in records)
    os.rename(f"{root}/in/.{name}", f"{root}/in/{name}")


def test_bins_close_when_full_or_old(spark, root):
    stage(root, "1.json", [(f"a{k}", "a") for k in range(25)] + [("b0", "b")])
    gather(spark, root, f"{root}/in", 10, 2, 26)
    found = files_of(f"{root}/out")
    assert all(len(f) == 1 for f in found.values())
    assert sorted(len(f[0]) for f in found.values()) == [1, 5, 10, 10]
    assert sorted(v for f in found.values() for v in f[0]) == sorted([f"a{k}" for k in range(25)] + ["b0"])
    bins = spark.read.parquet(f"{root}/out/bins").collect()
    assert sorted((b.kind, b.number, b.reason, b.n_records) for b in bins) == [("a", 0, FULL, 10), ("a", 1, FULL, 10), ("a", 2, OLD, 5), ("b", 0, OLD, 1)]
    assert all(2000 <= b.closed - b.opened < 30_000 for b in bins if b.reason == OLD)


def test_open_bins_outlive_a_restart(spark, root):
    stage(root, "1.json", [(f"a{k}", "a") for k in range(7)])
    gather(spark, root, f"{root}/in", 5, 600, 5)
    stage(root, "2.json", [(f"c{k}", "a") for k in range(3)])
    gather(spark, root, f"{root}/in", 5, 600, 10)
    bins = spark.read.parquet(f"{root}/out/bins").collect()
    assert sorted((b.number, b.n_records, b.reason) for b in bins) == [(0, 5, FULL), (1, 5, FULL)]
    assert sorted(v for b in bins for v in b.records) == sorted([f"a{k}" for k in range(7)] + [f"c{k}" for k in range(3)])


def test_a_frequent_kind_fills_several_bins_side_by_side(spark, root):
    stage(root, "1.json", [(f"a{k}", "a") for k in range(200)])
    gather(spark, root, f"{root}/in", 20, 2, 200, lanes=4)
    bins = spark.read.parquet(f"{root}/out/bins")
    assert bins.select("lane").distinct().count() == 4 and bins.agg(F.sum("n_records"), F.max("n_records")).first()[:] == (200, 20)


def test_a_stop_waits_for_one_micro_batch_only(spark, root):
    stage(root, "1.json", [("a0", "a")])
    lines = spark.readStream.schema("value string, kind string").json(f"{root}/in")
    query = start_binning(spark, lines, f"{root}/out", f"{root}/c", ["kind"], 10, 600, trigger={"processingTime": "0 seconds"})
    until = time.time() + 60
    while not query.lastProgress and time.time() < until:
        time.sleep(0.1)
    began = time.time()
    stop_between_batches(query, 60)  # empty micro-batches follow each other without a pause
    assert not query.isActive and time.time() - began < 30


def test_bins_of_many_micro_batches(spark, root, monkeypatch):
    monkeypatch.setattr(landing_queries, "BIN_FILE_RECORDS", 4000)
    monkeypatch.setattr(landing_queries, "BIN_BATCH_FILES", 1)
    kind = F.when(F.col("id") % 100 == 0, "rare").otherwise(F.when(F.col("id") % 2 == 0, "even").otherwise("odd"))
    spark.range(20_000).select(F.col("id").alias("event_id"), kind.alias("event_type")).write.parquet(f"{root}/events.parquet")
    staged = landing_queries.staged_for_bins(spark.read.parquet(f"{root}/events.parquet"), 20_000)
    files = staged.select("event_type", F.spark_partition_id().alias("file")).distinct().groupBy("event_type").count().collect()
    assert {r[0]: r[1] for r in files} == {"rare": 1, "even": 1, "odd": 5}
    found = landing_queries.records_binned_by_size_and_age(spark, root).collect()
    assert sorted((r.event_type, r.n_records, r.n_full, r.n_oversized, r.n_overaged, r.files_agree) for r in found) == [
        ("even", 9800, 19, 0, 0, True), ("odd", 10_000, 20, 0, 0, True), ("rare", 200, 0, 0, 0, True)
    ]
