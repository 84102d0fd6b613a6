"""Bases in buckets: what a compaction rewrites, what a merge shuffles, and that the rows are the same."""

import os
import random

import pytest

from helpers import at, customer, plan, raw_customers, rows
from millrace.functions.typed import typed
from millrace.operators.merge import merge_upsert
from millrace.specs import CUSTOMERS
from millrace.storage import BUCKET, Store
from millrace.streaming.loader import LoadOptions, merge_load


def load(spark, store, load_id, records, spec=CUSTOMERS):
    raw = raw_customers(spark, [(r,) if isinstance(r, dict) else r for r in records], spec, loaded=load_id)
    store.write_landed(raw, spec, load_id)
    merge_load(store, spec, store.raw(spec, load_id), load_id, LoadOptions(), at(load_id))
    return raw


def data_files(store, spec=CUSTOMERS):
    found = {}
    for folder, _, names in os.walk(store.base_path(spec)):
        found |= {os.path.join(folder, n): folder for n in names if n.endswith(".parquet")}
    return found


def buckets_of(spark, store, version):
    base = store.base(CUSTOMERS, version)
    return {r.id: r[BUCKET] for r in base.select("id", BUCKET).collect()}


def test_untouched_buckets_keep_their_files(spark, root):
    store = Store(spark, root, bucket_rows=20)
    load(spark, store, 1, [customer(k, "a", 1) for k in range(200)])
    assert store.compact(CUSTOMERS) == 1
    first, held = data_files(store), buckets_of(spark, store, 1)
    assert len(set(held.values())) > 8
    changed = [3, 5, 1000]
    load(spark, store, 2, [customer(k, "b", 2) for k in changed])
    assert store.compact(CUSTOMERS) == 2
    written = set(data_files(store)) - set(first)
    assert set(first) <= set(data_files(store))
    touched = {held[3], held[5], buckets_of(spark, store, 2)[1000]}
    assert {int(os.path.dirname(f).split(f"{BUCKET}=")[1]) for f in written} == touched
    expected = sorted([(k, "b" if k in changed else "a") for k in range(200)] + [(1000, "b")], key=repr)
    assert rows(store.typed(CUSTOMERS), "id", "status") == expected
    # the older base is still whole, for a read begun before
    assert store.base(CUSTOMERS, 1).count() == 200
    # pruning takes the old versions of the touched buckets only
    assert store.prune(CUSTOMERS, keep=1) == [1]
    gone = set(first) - set(data_files(store))
    assert {int(os.path.dirname(f).split(f"{BUCKET}=")[1]) for f in gone} == touched & set(held.values())
    assert rows(store.typed(CUSTOMERS), "id", "status") == expected


@pytest.mark.parametrize("changelog", [False, True])
def test_a_merge_does_not_shuffle_the_base(spark, root, changelog):
    spec = CUSTOMERS.as_changelog() if changelog else CUSTOMERS
    store = Store(spark, root, bucket_rows=10)
    load(spark, store, 1, [(customer(k, "a", 1), "INSERT", 1) for k in range(100)], spec)
    store.compact(spec)
    load(spark, store, 2, [(customer(k, "b", 2), "UPDATE", 2) for k in range(90, 120)], spec)
    lines = plan(store.typed(spec)).split("\n")
    (scan,) = [k for k, line in enumerate(lines) if "Bucketed: true" in line]
    (join,) = [k for k, line in enumerate(lines) if "FullOuter" in line]
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    above, at_depth = [], depth(lines[scan])
    for line in reversed(lines[join:scan]):
        if depth(line) < at_depth:
            above.append(line)
            at_depth = depth(line)
    assert above and not any("Exchange" in line for line in above)
    assert sum("Exchange" in line for line in lines[scan:]) >= 1
    assert rows(store.typed(spec), "id", "status") == sorted([(k, "a" if k < 90 else "b") for k in range(120)], key=repr)


def test_a_grown_table_is_dealt_anew(spark, root):
    store = Store(spark, root, bucket_rows=10)
    load(spark, store, 1, [customer(k, "a", 1) for k in range(10)])
    store.compact(CUSTOMERS)
    assert set(buckets_of(spark, store, 1).values()) == {0}
    load(spark, store, 2, [customer(k, "b", 2) for k in range(5, 100)])
    store.compact(CUSTOMERS)
    assert len(set(buckets_of(spark, store, 2).values())) > 4
    assert rows(store.typed(CUSTOMERS), "id", "status") == sorted([(k, "a" if k < 5 else "b") for k in range(100)], key=repr)


def test_bases_equal_merging_in_turn(spark, root):
    rng = random.Random(4)
    store, target = Store(spark, root, bucket_rows=8), None
    for n in range(1, 6):
        records = [customer(rng.randrange(60), f"s{n}-{k}", rng.randrange(24), created=n) for k in range(rng.choice([3, 40]))]
        raw = load(spark, store, n, records)
        target = merge_upsert(target, typed(raw, CUSTOMERS), CUSTOMERS, load_ts=at(n))
        if n % 2:
            store.compact(CUSTOMERS)
        if n == 4:
            store.prune(CUSTOMERS, keep=1)
        assert rows(store.typed(CUSTOMERS), *CUSTOMERS.typed_columns) == rows(target, *CUSTOMERS.typed_columns)


def test_an_unfinished_base_is_written_again(spark, root):
    store = Store(spark, root, bucket_rows=2)
    load(spark, store, 1, [customer(k, "a", 1) for k in range(9)])
    os.makedirs(f"{store.bases_path(CUSTOMERS)}/v=1/_temporary")
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{store.base_path(CUSTOMERS)}/v=1/{BUCKET}=0")
    assert store.base_version(CUSTOMERS) is None and len(rows(store.typed(CUSTOMERS), "id")) == 9
    assert store.compact(CUSTOMERS) == 1 and store.base_version(CUSTOMERS) == 1
    assert len(rows(store.typed(CUSTOMERS), "id")) == 9
    # a second store on the same folder, as after a restart
    assert len(rows(Store(spark, root).typed(CUSTOMERS), "id")) == 9


def test_an_empty_table_has_an_empty_base(spark, root):
    store = Store(spark, root)
    load(spark, store, 1, [])
    assert store.compact(CUSTOMERS) in (None, 1) and store.typed(CUSTOMERS).count() == 0
    load(spark, store, 2, [customer(1, "a", 1)])
    store.compact(CUSTOMERS)
    assert rows(store.typed(CUSTOMERS), "id", "status") == [(1, "a")]
