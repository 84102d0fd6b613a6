import random
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import at, customer, plan, raw_customers, rows
from millrace.functions.typed import typed
from millrace.operators import merge as m
from millrace.operators.latest import latest_per_key, newest_rows
from millrace.operators.merge import apply_changelog, as_changes, fits_broadcast, fold_loads, insert_all, merge_changes, merge_upsert, reduce_batch
from millrace.specs import CUSTOMERS, LOAD_ID, ORDERS, SPECS, table_ddl

LOG = CUSTOMERS.as_changelog()
SHOWN = ("id", "status", "created_at", "updated_at", "is_deleted", "_cdc_timestamp")
UPDATED = ("id", "status", "updated_at", "_cdc_timestamp")


def batch(spark, records, **kw):
    return typed(raw_customers(spark, records, **kw), CUSTOMERS)


def test_insert_update_premium_deleted(spark):
    steps = [customer(1, "active", 0), customer(1, "premium", 1), customer(1, "deleted", 2)]
    target = None
    for i, record in enumerate(steps):
        target = merge_upsert(target, batch(spark, [(record, "UPSERT", i)]), CUSTOMERS, load_ts=at(i))
        assert rows(target, "status", "is_deleted") == [(record["status"], False)]
    row = target.first()
    assert row.created_at == at(0) and row.updated_at == at(2) and row._etl_loaded_at == at(2)


def test_newest_of_several_rows_wins(spark):
    records = [
        (customer(1, "old", 1),),
        (customer(1, "new", 2),),
        (customer(1, "none", None),),
        (customer(2, "first", 5), "UPSERT", 0, 1),
        (customer(2, "tie, later time", 5), "UPSERT", 3, 0),
        (customer(3, "line 1", 5), "UPSERT", 0, 1),
        (customer(3, "line 2", 5), "UPSERT", 0, 2),
        (customer(4, "only", None),),
    ]
    out = merge_upsert(None, batch(spark, records), CUSTOMERS)
    assert rows(out, "id", "status") == [(1, "new"), (2, "tie, later time"), (3, "line 2"), (4, "only")]


def test_columns_only_inserted_stay(spark):
    def order(day, currency, amount):
        return {
            "id": 1, "customer_id": 7, "order_date": day, "status": "pending", "total_amount": amount,
            "currency": currency, "created_at": day, "updated_at": day, "notes": "ignored",
        }

    spec = ORDERS
    first = typed(raw_customers(spark, [(order("2024-01-01", "GBP", 1.5),)]), spec)
    second = typed(raw_customers(spark, [(order("2024-02-01", "EUR", 2.5),)]), spec)
    row = merge_upsert(merge_upsert(None, first, spec), second, spec).first()
    assert str(row.order_date) == "2024-01-01" and row.currency == "GBP" and str(row.total_amount) == "2.50"
    assert row.notes is None and row.shipping_address is None and row.is_deleted is False


def test_late_row_only_wins_without_guard(spark):
    target = merge_upsert(None, batch(spark, [(customer(1, "new", 5),)]), CUSTOMERS)
    late = batch(spark, [(customer(1, "late", 1),)])
    assert rows(merge_upsert(target, late, CUSTOMERS), "status") == [("new",)]
    assert rows(merge_upsert(target, late, CUSTOMERS, guard=False), "status") == [("late",)]
    tie = batch(spark, [(customer(1, "tie", 5),)])
    assert rows(merge_upsert(target, tie, CUSTOMERS), "status") == [("tie",)]
    undated = batch(spark, [(customer(1, "undated", None),)])
    assert rows(merge_upsert(target, undated, CUSTOMERS), "status") == [("new",)]


def test_row_without_key_is_refused(spark):
    target = merge_upsert(None, batch(spark, [(customer(1, "a", 1),)]), CUSTOMERS)
    keyless = batch(spark, [(customer(2, "b", 1),)]).withColumn("id", m.F.lit(None).cast("bigint"))
    for into in (target, None):
        with pytest.raises(Exception, match="a row without id"):
            merge_upsert(into, keyless, CUSTOMERS).collect()


record = st.tuples(st.integers(1, 4), st.sampled_from("abcd"), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 3))
quick = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def as_rows(drawn):
    return [(customer(k, s, h, created=i), "UPSERT", c, i) for i, (k, s, h, c) in enumerate(drawn)]


@quick
@given(st.lists(record, min_size=1, max_size=12), st.integers(0, 12))
def test_merge_properties(spark, drawn, cut):
    records = as_rows(drawn)
    whole = merge_upsert(None, batch(spark, records), CUSTOMERS, load_ts=at(0))
    keys = [r[0] for r in rows(whole, "id")]
    assert keys == sorted(set(keys)) == sorted({r[0]["id"] for r in records})
    # The same batch again changes nothing.
    again = merge_upsert(whole, batch(spark, records), CUSTOMERS, load_ts=at(0))
    assert rows(again, *SHOWN) == rows(whole, *SHOWN)
    # Two batches in order give what one gives, for the updated columns.
    first, second = records[:cut], records[cut:]
    target = merge_upsert(None, batch(spark, first), CUSTOMERS) if first else None
    if second:
        source = batch(spark, second, loaded=1)
        target = merge_upsert(target, source, CUSTOMERS)
    if not (first and second):
        assert rows(target, *UPDATED) == rows(whole, *UPDATED)
    else:
        order = {k: max(((r[0]["updated_at"] or ""), r[2]) for r in records if r[0]["id"] == k) for k in keys}
        got = {r[0]: r for r in rows(target, "id", "updated_at", "_cdc_timestamp")}
        for k, (stamp, cdc) in order.items():
            assert (got[k][1].isoformat() if got[k][1] else "") == stamp and got[k][2] == at(cdc)


@quick
@given(st.lists(st.lists(record, min_size=1, max_size=5), min_size=1, max_size=4), st.booleans())
def test_folding_loads_equals_merging_them_in_turn(spark, drawn, guard):
    changes, target = None, None
    for n, load in enumerate(drawn):
        source = batch(spark, as_rows(load), loaded=n, batch=f"b{n}")
        one = as_changes(reduce_batch(source, CUSTOMERS), CUSTOMERS, at(n)).withColumn(LOAD_ID, m.F.lit(n).cast("bigint"))
        changes = one if changes is None else changes.unionByName(one)
        target = merge_upsert(target, source, CUSTOMERS, guard, at(n))
    folded = insert_all(fold_loads(changes, CUSTOMERS, guard), CUSTOMERS)
    assert rows(folded, *CUSTOMERS.typed_columns) == rows(target, *CUSTOMERS.typed_columns)


def test_broadcast_merge_equals_shuffled_merge(spark):
    rng = random.Random(3)
    old = [(customer(k, f"s{k}", rng.randint(0, 9)),) for k in range(60)]
    new = [(customer(k, f"n{k}", rng.randint(0, 9)),) for k in range(40, 90)]
    target = merge_upsert(None, batch(spark, old), CUSTOMERS, load_ts=at(0))
    changes = as_changes(reduce_batch(batch(spark, new), CUSTOMERS), CUSTOMERS, at(1))
    shuffled = merge_changes(target, changes, CUSTOMERS)
    small = merge_changes(target, changes, CUSTOMERS, source_rows=50)
    assert rows(small, *CUSTOMERS.typed_columns) == rows(shuffled, *CUSTOMERS.typed_columns)
    assert "BroadcastHashJoin" in plan(small) and "SortMergeJoin" not in plan(small)
    too_many = m.BROADCAST_BYTES // CUSTOMERS.row_bytes() + 1
    assert "FullOuter" in plan(merge_changes(target, changes, CUSTOMERS, source_rows=too_many))


@pytest.mark.parametrize("name", sorted(SPECS))
def test_every_spec_merges(spark, name):
    spec = SPECS[name]
    record = {}
    values = {"bigint": 5, "string": "000000000000000005", "boolean": True, "date": "2024-01-01"}
    for f in spec.fields:
        if f.path:
            default = "2024-01-01T00:00:00" if f.type == "timestamp_ntz" else 1.25
            record[f.path[2:]] = values.get(f.type, default)
    raw = raw_customers(spark, [(record,)]).drop(*([] if spec.change_columns else ["_cdc_operation", "_cdc_timestamp"]))
    out = merge_upsert(None, typed(raw, spec, on_long="truncate"), spec)
    assert tuple(out.columns) == spec.typed_columns
    assert [f.dataType for f in out.schema] == [f.dataType for f in spec.typed_schema]
    assert out.first().is_deleted is spec.carries_deleted


def play(log, keep_tombstones):
    """A change log applied one change at a time."""
    table = {}
    for key, op, status, hours in log:
        row = table.get(key)
        if op == "DELETE":
            if row:
                row.update(is_deleted=True, ts=hours)
            elif keep_tombstones:
                table[key] = {"status": None, "created": None, "is_deleted": True, "ts": hours}
            continue
        if row is None:
            table[key] = {"status": status, "created": hours, "is_deleted": False, "ts": hours}
        else:
            row.update(status=status, is_deleted=False, ts=hours)
    return sorted((k, r["status"], at(r["created"]), r["is_deleted"], at(r["ts"])) for k, r in table.items())


change = st.tuples(st.integers(1, 3), st.sampled_from(["INSERT", "UPDATE", "DELETE"]), st.sampled_from("abc"))


@quick
@given(st.lists(change, min_size=1, max_size=12), st.integers(0, 12), st.booleans())
def test_changelog_equals_playing_it(spark, drawn, cut, keep):
    seen, log = set(), []
    for i, (key, op, status) in enumerate(drawn):
        # A delete of a key that never had data leaves nothing to keep its first values in.
        if op != "DELETE" and keep and key in seen and not any(k == key and o != "DELETE" for k, o, _, _ in log):
            continue
        seen.add(key)
        log.append((key, op, status, i))
    target = None
    for part in (log[:cut], log[cut:]):
        if part:
            records = [
                ({"id": k} if op == "DELETE" else customer(k, s, h, created=h), op, h) for k, op, s, h in part
            ]
            target = apply_changelog(target, typed(raw_customers(spark, records), LOG), LOG, keep)
    assert rows(target, "id", "status", "created_at", "is_deleted", "_cdc_timestamp") == sorted(play(log, keep), key=repr)


@pytest.mark.parametrize("keep", [False, True])
def test_broadcast_changelog_equals_shuffled_changelog(spark, keep):
    rng = random.Random(5)
    first = [(customer(k, f"s{k}", k % 7, created=k), "INSERT", k % 7) for k in range(40)]
    target = apply_changelog(None, typed(raw_customers(spark, first), LOG), LOG)
    later = []
    for h in range(60):
        k, op = rng.randrange(60), rng.choice(["INSERT", "UPDATE", "DELETE"])
        later.append(({"id": k} if op == "DELETE" else customer(k, f"n{h}", h % 12, created=h), op, h % 12))
    changes = typed(raw_customers(spark, later), LOG)
    shuffled = apply_changelog(target, changes, LOG, keep)
    small = apply_changelog(target, changes, LOG, keep, source_rows=60)
    assert rows(small, *LOG.typed_columns) == rows(shuffled, *LOG.typed_columns)
    assert "BroadcastHashJoin" in plan(small) and "FullOuter" not in plan(small)


def test_changelog_ignores_late_changes(spark):
    target = apply_changelog(None, typed(raw_customers(spark, [(customer(1, "new", 5), "INSERT", 5)]), LOG), LOG)
    late = [(customer(1, "late", 2), "UPDATE", 2), ({"id": 1}, "DELETE", 3)]
    out = apply_changelog(target, typed(raw_customers(spark, late), LOG), LOG)
    assert rows(out, "status", "is_deleted") == [("new", False)]
    # A late update beside a fresh delete does not bring its data along.
    mixed = [(customer(1, "late", 2), "UPDATE", 2), ({"id": 1}, "DELETE", 9)]
    out = apply_changelog(target, typed(raw_customers(spark, mixed), LOG), LOG)
    assert rows(out, "status", "is_deleted", "updated_at") == [("new", True, at(5))]


def test_latest_row_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as v")
    text = plan(latest_per_key(df, ["k"], ["v"]))
    assert "row_number(), 1, Partial" in text and text.index("Exchange") < text.index("Partial")
    assert rows(latest_per_key(df, ["k"], ["v"]), "k", "v") == [(0, 999), (1, 997), (2, 998)]


def test_merging_into_a_reduced_table_shuffles_each_side_once(spark):
    first, second = batch(spark, [(customer(1, "a", 1),)]), batch(spark, [(customer(1, "b", 2),)])
    merged = merge_upsert(merge_upsert(None, first, CUSTOMERS), second, CUSTOMERS)
    assert plan(merged).count("Exchange hashpartitioning") == 2


def test_newest_rows_do_not_sort_the_table(spark):
    df = spark.range(100).selectExpr("id % 7 as v", "id")
    out = newest_rows(df, ["v", "id"], 3)
    assert "TakeOrderedAndProject" in plan(out)
    assert [r.id for r in out.collect()] == [97, 90, 83]


def test_merge_into_needs_a_table_with_row_level_operations(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS typed")
    spark.sql(table_ddl(CUSTOMERS, "typed.customers"))
    changes = as_changes(reduce_batch(batch(spark, [(customer(1, "a", 1),)]), CUSTOMERS), CUSTOMERS, at(0))
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        m.merge_into_table("typed.customers", changes, CUSTOMERS)


def test_a_string_without_a_length_is_never_small(spark):
    unbounded = replace(CUSTOMERS, fields=(*CUSTOMERS.fields[:-1], replace(CUSTOMERS.fields[1], name="note", length=None), CUSTOMERS.fields[-1]))
    assert fits_broadcast(CUSTOMERS, 10) and not fits_broadcast(unbounded, 1)
