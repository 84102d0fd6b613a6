"""Summaries of loads beside the rows they stand for."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import at, customer, raw_customers, rows
from millrace.operators import sketches
from millrace.specs import ACCOUNTS, CUSTOMERS
from millrace.storage import Store

EXPECTED = [0, 1, 2, 5, 32767, 32768, 32769, 65536, 10**12, -1, -32768, -40000]


def land(store, spark, load_id, ids, day=0, spec=CUSTOMERS):
    raw = raw_customers(spark, [(customer(k, "a", 1),) for k in ids], spec, loaded=24 * day + 2)
    store.write_landed(raw, spec, load_id)
    store.write_summaries(spec, load_id)


def test_bitmaps_tell_which_keys_arrived(spark, root):
    store = Store(spark, root)
    expected = spark.createDataFrame([(k,) for k in EXPECTED + [None, 5]], "id bigint")
    assert sketches.arrived_by_bitmap(expected, store.summaries(CUSTOMERS), "id").first().n_arrived == 0
    assert sketches.missing_by_bitmap(expected, store.summaries(CUSTOMERS), "id").count() == len(EXPECTED)
    loads = [[0, 5, 5, 32768], [32769, 7, -1], [10**12, -40000, None, 0]]
    for n, ids in enumerate(loads):
        land(store, spark, n, ids, day=n)
    for _ in range(2):
        found = store.summaries(CUSTOMERS)
        seen = set(EXPECTED) & {k for ids in loads for k in ids}
        assert sketches.arrived_by_bitmap(expected, found, "id").first().n_arrived == len(seen)
        assert rows(sketches.missing_by_bitmap(expected, found, "id"), "id") == sorted([(k,) for k in set(EXPECTED) - seen], key=repr)
        store.fold_days(CUSTOMERS, "2024-01-03")
    assert len(store.open_loads(CUSTOMERS)) == 1
    # a load that is repeated after its fold does not count again, nor does a repeat before it
    land(store, spark, 0, loads[0])
    land(store, spark, 2, loads[2], day=2)
    assert sketches.merged_latency(store.summaries(CUSTOMERS)).first().n_rows == 11


def test_random_keys_against_sets(spark, root):
    rng, store, seen = random.Random(6), Store(spark, root), set()
    for n in range(4):
        ids = [rng.randrange(-100_000, 100_000) for _ in range(500)]
        seen |= set(ids)
        land(store, spark, n, ids, day=n % 2)
    store.fold_days(CUSTOMERS, "2024-01-02")
    wanted = [rng.randrange(-100_000, 100_000) for _ in range(3000)] + list(seen)[::3]
    expected = spark.createDataFrame([(k,) for k in wanted], "id bigint")
    assert sketches.arrived_by_bitmap(expected, store.summaries(CUSTOMERS), "id").first().n_arrived == len(set(wanted) & seen)
    assert {r.id for r in sketches.missing_by_bitmap(expected, store.summaries(CUSTOMERS), "id").collect()} == set(wanted) - seen


def test_keys_that_are_no_numbers_have_no_bitmap(spark, root):
    store = Store(spark, root)
    raw = raw_customers(spark, [({"Id": "a" * 18, "LastModifiedDate": at(1).isoformat()},)], ACCOUNTS, loaded=3).drop("_cdc_operation", "_cdc_timestamp")
    store.write_landed(raw, ACCOUNTS, 0)
    store.write_summaries(ACCOUNTS, 0)
    (row,) = store.summaries(ACCOUNTS).collect()
    assert (row.kind, row.n_rows, row.max_seconds) == (sketches.LATENCY, 1, 7200)


@pytest.mark.parametrize("share", [0.5, 0.95, 0.99])
def test_rank_error_of_merged_sketches(spark, share):
    rng = random.Random(3)
    parts, seconds = [], []
    for n in range(12):
        some = [int(rng.lognormvariate(4, 1.5)) for _ in range(5000)]
        seconds += some
        df = spark.createDataFrame([(k, s) for k, s in enumerate(some)], "id bigint, s bigint").select(
            F.col("id").alias("_key"), F.lit(at(24 * (n % 3))).cast("timestamp_ntz").alias("_loaded_at"),
            (F.lit(at(24 * (n % 3))).cast("timestamp_ntz") - F.make_dt_interval(secs=F.col("s"))).alias("_cursor"),
        )
        parts.append(sketches.summaries(df))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    for rows_ in (found, sketches.merged_summaries(found)):
        told = sketches.merged_latency(rows_, share).first()
        assert (told.n_rows, told.max_seconds) == (len(seconds), max(seconds))
        assert told.avg_seconds == pytest.approx(sum(seconds) / len(seconds))
        below = sum(s < told.quantile_seconds for s in seconds) / len(seconds)
        upto = sum(s <= told.quantile_seconds for s in seconds) / len(seconds)
        assert below - 0.01 <= share <= upto + 0.01
