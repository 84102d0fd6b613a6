import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import raw_customers
from millrace.functions.typed import cast_field, convert_record, split_bad, typed
from millrace.specs import CUSTOMERS, Field


def value(spark, text, field, **kw):
    df = spark.createDataFrame([(text,)], "j string").select(F.parse_json("j").alias("r"))
    return df.select(cast_field(F.col("r"), field, **kw)).first()[0]


@pytest.mark.parametrize(
    "text,type_,expected",
    [
        ('{"x": 12}', "bigint", 12),
        ('{"x": "12"}', "bigint", 12),
        ('{"x": 1.5}', "bigint", 2),
        ('{"x": -1.5}', "bigint", -2),
        ('{"x": null}', "bigint", None),
        ("{}", "bigint", None),
        ('{"X": 12}', "bigint", None),
        ('{"x": 1.235}', "decimal(12,2)", Decimal("1.24")),
        ('{"x": -1.235}', "decimal(12,2)", Decimal("-1.24")),
        ('{"x": "1.235"}', "decimal(12,2)", Decimal("1.24")),
        ('{"x": "2024-02-29"}', "date", dt.date(2024, 2, 29)),
        ('{"x": "2024-01-01T00:00:00.000001"}', "timestamp_ntz", dt.datetime(2024, 1, 1, 0, 0, 0, 1)),
        ('{"x": "2024-01-01T05:00:00+02:00"}', "timestamp_ntz", dt.datetime(2024, 1, 1, 5)),
        ('{"x": "2024-01-01T05:00:00Z"}', "timestamp_ntz", dt.datetime(2024, 1, 1, 5)),
        ('{"x": "2024-01-01T05:00:00.000+0000"}', "timestamp_ntz", dt.datetime(2024, 1, 1, 5)),
        ('{"x": true}', "boolean", True),
        ('{"x": 7}', "string", "7"),
    ],
)
def test_cast(spark, text, type_, expected):
    assert value(spark, text, Field("x", type_, "$.x")) == expected


def test_normalized_to_utc(spark):
    field = Field("x", "timestamp_ntz", "$.x")
    assert value(spark, '{"x": "2024-01-01T05:00:00+02:00"}', field, normalize_utc=True) == dt.datetime(2024, 1, 1, 3)


def test_epoch_millis(spark):
    field = Field("x", "timestamp_ntz", "$.x", unit="millis")
    assert value(spark, '{"x": 1704067200123}', field) == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)


@pytest.mark.parametrize("text,type_", [('{"x": "no"}', "bigint"), ('{"x": "no"}', "date"), ('{"x": 12345678901.5}', "decimal(12,2)")])
def test_bad_value_fails_or_is_null(spark, text, type_):
    field = Field("x", type_, "$.x")
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST|CAST"):
        value(spark, text, field)
    assert value(spark, text, field, strict=False) is None


def test_too_large_integer(spark):
    field = Field("x", "bigint", "$.x")
    with pytest.raises(Exception, match="OVERFLOW"):
        value(spark, '{"x": 92233720368547758070}', field)
    assert value(spark, '{"x": 92233720368547758070}', field, strict=False) is None


def test_missing_key_fails(spark):
    with pytest.raises(Exception, match="id is missing"):
        typed(raw_customers(spark, [({"status": "active"},)]), CUSTOMERS).collect()


def test_unknown_fields_are_ignored_and_missing_ones_null(spark):
    row = typed(raw_customers(spark, [({"id": 1, "colour": "red"},)]), CUSTOMERS).first()
    assert row.id == 1 and row.email is None and "colour" not in row.asDict()


def test_length_policies(spark):
    raw = raw_customers(spark, [({"id": 1, "status": "x" * 25},)])
    assert typed(raw, CUSTOMERS, on_long="truncate").first().status == "x" * 20
    with pytest.raises(Exception, match="status is longer than 20"):
        typed(raw, CUSTOMERS, on_long="fail").collect()
    good, bad = split_bad(typed(raw, CUSTOMERS, on_long="quarantine"))
    assert good.count() == 0 and bad.first()._bad_fields == ["status"]
    with pytest.raises(ValueError):
        typed(raw, CUSTOMERS, on_long="guess")


def test_quarantine_names_the_bad_columns(spark):
    raw = raw_customers(
        spark,
        [
            ({"id": 1, "updated_at": "2024-01-01T00:00:00"},),
            ({"id": "x", "updated_at": "yesterday"},),
            ({"updated_at": None},),
        ],
    )
    good, bad = split_bad(typed(raw, CUSTOMERS, on_bad="quarantine"))
    assert [r.id for r in good.collect()] == [1]
    assert sorted(r._bad_fields for r in bad.collect()) == [["id"], ["id", "updated_at"]]
    with pytest.raises(ValueError):
        typed(raw, CUSTOMERS, on_bad="guess")


def test_converted_records_keep_micros_and_known_fields(spark):
    raw = raw_customers(spark, [({"id": 1, "updated_at": "2024-01-01T00:00:00.000001", "colour": "red"},)])
    assert convert_record(raw, CUSTOMERS).first().value == '{"id":1,"updated_at":"2024-01-01T00:00:00.000001"}'


def test_key_is_never_cut(spark):
    from millrace.specs import ACCOUNTS

    raw = raw_customers(spark, [({"Id": "001000000000000AAAx", "Name": "a"},), ({"Id": "001000000000000AAA", "Name": "b"},)], ACCOUNTS)
    with pytest.raises(Exception, match="sf_id is longer than 18"):
        typed(raw, ACCOUNTS).collect()
    good, bad = split_bad(typed(raw, ACCOUNTS, on_bad="quarantine"))
    assert [r.sf_id for r in good.collect()] == ["001000000000000AAA"]
    assert bad.first()._bad_fields == ["sf_id"]
