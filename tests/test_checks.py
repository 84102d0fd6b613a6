import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import at, customer, plan, raw_customers, rows
from millrace.operators import checks, watch
from millrace.operators.files import expired_files, new_files, with_line_counts
from millrace.operators.routes import split_routes, write_routes
from millrace.plans import catalog
from millrace.specs import ACCOUNTS, CUSTOMERS, SPECS, raw_table_ddl, table_ddl


def test_point_lookup_and_lists(spark, monkeypatch):
    raw = raw_customers(spark, [(customer(k, "a", 1),) for k in (1, 2, 2, 3)])
    assert checks.raw_point_lookup(raw, CUSTOMERS, 2).count() == 2
    short = checks.raw_in_list(raw, CUSTOMERS, [2, 3, 9])
    assert short.count() == 3 and "Join" not in plan(short)
    assert checks.raw_in_list(raw, CUSTOMERS, ["2", "3"]).count() == 3
    monkeypatch.setattr(checks, "IN_LIST_MAX", 2)
    long = checks.raw_in_list(raw, CUSTOMERS, [2, 3, 9])
    assert long.count() == 3 and "BroadcastHashJoin" in plan(long) and "LeftSemi" in plan(long)
    assert checks.raw_in_list(raw, CUSTOMERS, ["2", "3", "9"]).count() == 3  # text keys, on either side of the limit
    keys = spark.createDataFrame([(2,), (3,), (9,)], "id bigint")
    assert checks.raw_in_list(raw, CUSTOMERS, keys).count() == 3


def test_conformance_counts_missing_null_and_bad(spark):
    raw = raw_customers(
        spark,
        [
            ({"id": 1, "updated_at": "2024-01-01T00:00:00"},),
            ({"id": "2", "updated_at": None},),
            ({"id": "x"},),
        ],
    )
    fields = [CUSTOMERS.field("id"), CUSTOMERS.field("updated_at")]
    got = rows(checks.field_conformance(raw, fields), "field", "n_rows", "n_null", "n_bad")
    assert got == [("id", 3, 0, 1), ("updated_at", 3, 2, 0)]


def test_required_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    assert rows(checks.required_nulls(df, ["a", "b"]), "column_name", "n_rows", "n_null") == [("a", 3, 1), ("b", 3, 2)]


def test_id_length(spark):
    raw = raw_customers(spark, [({"Id": "x" * 15},), ({"Id": "x" * 18},), ({"Id": "x" * 16},), ({"id": "x" * 15},)])
    assert tuple(checks.id_length_check(raw).first()) == (4, 2, 2)


def test_uniqueness(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert tuple(checks.uniqueness(df, "k").first()) == (4, 2, 1, False)
    assert tuple(checks.uniqueness(df.filter("k = 2"), "k").first()) == (1, 1, 0, True)
    assert tuple(checks.uniqueness(df.filter("k = 9"), "k").first()) == (0, 0, 0, True)
    assert rows(checks.repeated_keys(df, "k"), "k", "n") == [(1, 2)]


def test_orphans_keep_every_row(spark):
    parent = spark.createDataFrame([(1,)], "id int")
    child = spark.createDataFrame([(1, 10), (2, 20), (2, 21), (None, 30)], "ref int, n int")
    assert rows(checks.orphans(child, parent, "ref", "id"), "n") == [(20,), (21,)]


def test_arrivals(spark):
    expected = spark.range(100).withColumnRenamed("id", "k")
    raw = spark.range(95).selectExpr("id as k").unionByName(spark.range(50).selectExpr("id as k"))
    raw = raw.unionByName(spark.createDataFrame([(500,)], "k long"))
    assert checks.arrived(expected, raw, "k").first().n_arrived == 95
    assert tuple(checks.completeness(expected, raw, "k").first()) == (100, 95, 0.95, True)
    assert checks.completeness(expected, raw.filter("k > 0"), "k").first().is_complete is False
    assert rows(checks.missing_ids(expected, raw, "k"), "k") == [(k,) for k in range(95, 100)]
    assert checks.completeness(expected.limit(0), raw, "k").first().ratio is None


def test_emptiness_and_active_rows(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, is_deleted boolean")
    assert rows(checks.active_rows(df), "id") == [(2,)]
    assert checks.non_empty(df) and not checks.non_empty(df.filter("id > 9"))
    report = checks.non_empty_report({"a": df, "b": df.filter("id > 9")})
    assert rows(report, "table_name", "has_rows") == [("a", True), ("b", False)]


def test_freshness_and_staleness(spark):
    def loaded(*hours):
        return spark.createDataFrame([(at(h),) for h in hours], "_loaded_at timestamp_ntz")

    report = watch.freshness({"a": loaded(1, 5), "b": loaded(9), "c": loaded()})
    stale = watch.stale_feeds(report, at(10))
    assert rows(stale, "table_name", "n_rows", "last_loaded_at", "is_stale") == [
        ("a", 2, at(5), True), ("b", 1, at(9), False), ("c", 0, None, True),
    ]
    edge = watch.stale_feeds(watch.freshness({"a": loaded(8)}), at(10))
    assert edge.first().is_stale is False
    assert tuple(watch.landed_since(loaded(1, 8, 9, 10), at(9), 1).first()) == (2, at(9), at(10))


def test_growth(spark):
    before = spark.createDataFrame([("a", 5), ("b", 5)], "table_name string, n_rows long")
    after = spark.createDataFrame([("a", 5), ("b", 4), ("c", 1)], "table_name string, n_rows long")
    assert rows(watch.growth(before, after), "table_name", "has_dropped") == [("a", False), ("b", True), ("c", False)]


def test_operations_and_rates(spark):
    df = spark.createDataFrame([("UPSERT", at(1)), ("UPSERT", at(5)), ("DELETE", at(5))], "_cdc_operation string, _etl_loaded_at timestamp_ntz")
    assert rows(watch.ops_by_type(df), "_cdc_operation", "n_rows") == [("DELETE", 1), ("UPSERT", 2)]
    assert rows(watch.ops_by_type(df, at(5), 1), "_cdc_operation", "n_rows") == [("DELETE", 1), ("UPSERT", 1)]
    audit = spark.createDataFrame([("t", at(1), 100), ("t", at(2), 260), ("t", at(9), 1)], "table_name string, last_load_time timestamp_ntz, row_count long")
    assert tuple(watch.throughput(audit, at(1), at(2)).first()) == ("t", 260, 260 / 3600)


def test_latency_percentile_is_exact(spark):
    seconds = [0, 1, 2, 3, 60, 60, 61, 65, 90, 300]
    data = [(at(0), at(0) + dt.timedelta(seconds=s)) for s in seconds]
    df = spark.createDataFrame(data, "updated_at timestamp_ntz, _loaded_at timestamp_ntz")
    row = watch.latency(df, "updated_at").first()
    assert (row.n_rows, row.avg_seconds, row.max_seconds) == (10, 64.2, 300)
    assert row.p95_seconds == pytest.approx(90 + 0.55 * 210)


def test_files(spark):
    files = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 1)), ("c", dt.date(2024, 1, 4))], "file string, dt date")
    audit = spark.createDataFrame([("a",), ("c",)], "file string")
    assert rows(new_files(files, audit), "file") == [("b",)]
    # b is old enough but still waiting to be loaded.
    assert rows(expired_files(files, audit, "2024-01-05 12:00:00"), "file") == [("a",)]
    assert rows(expired_files(files, audit, "2024-01-04 12:00:00"), "file") == []
    assert rows(expired_files(files, audit, "2024-01-05 12:00:00", 30), "file") == []


def test_routes_part_the_rows(spark, root):
    df = spark.createDataFrame([("INSERT", 1), ("DELETE", 2), (None, 3), ("x", 4)], "op string, n int")
    parts = split_routes(df, "op", ["INSERT", "DELETE"])
    assert {k: rows(v, "n") for k, v in parts.items()} == {"INSERT": [(1,)], "DELETE": [(2,)], "unmatched": [(3,), (4,)]}
    write_routes(df, "op", ["INSERT", "DELETE"], f"{root}/routes")
    assert rows(spark.read.parquet(f"{root}/routes"), "_route", "n") == [("DELETE", 2), ("INSERT", 1), ("unmatched", 3), ("unmatched", 4)]


@pytest.mark.parametrize("name", sorted(SPECS))
def test_tables_can_be_created(spark, name):
    spec = SPECS[name]
    spark.sql("CREATE DATABASE IF NOT EXISTS made")
    for sql, table, schema in (
        (raw_table_ddl(spec, f"made.{spec.raw_name}"), spec.raw_name, spec.raw_schema),
        (table_ddl(spec, f"made.{name}"), name, spec.typed_schema),
    ):
        spark.sql(sql)
        made = spark.table(f"made.{table}")
        assert [(f.name, f.dataType) for f in made.schema] == [(f.name, f.dataType) for f in schema]
    key = "1" if spec.field(spec.key).type == "bigint" else "'1'"
    spark.sql(f"INSERT INTO made.{name} ({spec.key}) VALUES ({key})")
    row = spark.table(f"made.{name}").first()
    assert row.is_deleted is False and row._etl_loaded_at is not None
    spark.sql(f"INSERT INTO made.{spec.raw_name} (_raw_json) SELECT parse_json('{{}}')")
    assert spark.table(f"made.{spec.raw_name}").first()._loaded_at is not None


def test_specs_hold_together():
    for spec in SPECS.values():
        names = [f.name for f in spec.fields]
        assert set(spec.updated) <= set(spec.inserted) <= set(names)
        assert spec.key in spec.inserted and spec.key not in spec.updated and spec.cursor in spec.updated
        assert spec.typed_schema[spec.key].nullable is False
    assert CUSTOMERS.insert_only == ("created_at",) and ACCOUNTS.insert_only == ("created_date",)


@pytest.fixture
def small_skew_limits(spark):
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_key_is_split_in_joins_that_keep_rows(spark, root, small_skew_limits):
    n = 30_000
    rows_ = spark.range(0, n, 1, 8).selectExpr("if(id % 3 = 0, 7, id) as k", "id", "cast(id as string) as s")
    rows_.select(
        F.to_variant_object(F.struct(F.col("k").alias("id"), F.col("s").alias("status"))).alias("_raw_json")
    ).write.parquet(f"{root}/raw")
    raw = spark.read.parquet(f"{root}/raw")
    listed = checks.raw_in_list(raw, CUSTOMERS, spark.range(0, n))
    assert len(listed.collect()) == n and "SortMergeJoin(skew=true)" in plan(listed)
    child = checks.orphans(rows_, spark.range(10, n), "k", "id").select("k", "s")
    assert len(child.collect()) == n // 3 + 6 and "SortMergeJoin(skew=true)" in plan(child)


def test_waiting_files_tell_their_lines(spark):
    files = spark.createDataFrame([("a",), ("b",), ("empty",)], "file string")
    lines = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b"), ("4", "other")], "value string, _source_file string")
    assert rows(with_line_counts(files, lines), "file", "n_rows") == [("a", 2), ("b", 1), ("empty", 0)]


def test_load_once_counts_the_rows_of_each_file():
    assert "count(*) AS n_rows" in catalog.SQL["load_once"]
