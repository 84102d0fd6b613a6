import json
import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.records import TOO_LARGE, VARIANT_BYTES, parse_lines, parse_records

CASES = [
    ('{"a":1}', ["{\"a\":1}"]),
    ('  {"a":1}\t', ["{\"a\":1}"]),
    ('[{"a":1},{"a":2}]', ["{\"a\":1}", "{\"a\":2}"]),
    (' [ {"a":1} ] ', ["{\"a\":1}"]),
    ("[]", []),
    ("", []),
    (" \t ", []),
    ('{"a":1} junk', ["malformed"]),
    ('{"a":1}{"a":2}', ["malformed"]),
    ('{"a":1},', ["malformed"]),
    ('{"a":1},{"a":2}', ["trailing data"]),
    ('{"a":1},null', ["trailing data"]),
    ("{'a':1}", ["malformed"]),
    ('{"a":1,"a":2}', ["malformed"]),
    ('{"a":NaN}', ["malformed"]),
    ('[{"a":1}', ["malformed"]),
    ("null", ["not an object"]),
    ('"s"', ["not an object"]),
    ("17", ["not an object"]),
    ("][", ["trailing data"]),
    ('{"a":1}][{"a":2}', ["trailing data"]),
    ('{"a":1}] junk', ["trailing data"]),
    ('[{"a":1}]] [', ["trailing data"]),
    ('{"a":1},0]', ["trailing data"]),
    ('[{"a":1},5,null,[],{"a":2}]', ["not an object"] * 3 + ["{\"a\":1}", "{\"a\":2}"]),
]


@pytest.fixture(scope="module")
def outcomes(spark):
    lines = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, value string")
    parsed = parse_lines(lines).select("i", F.coalesce("reason", F.to_json("record")).alias("o"))
    found = {}
    for row in parsed.collect():
        found.setdefault(row.i, []).append(row.o)
    return found


@pytest.mark.parametrize("i", range(len(CASES)), ids=[c[0] or "blank" for c in CASES])
def test_line(outcomes, i):
    assert sorted(outcomes.get(i, [])) == sorted(CASES[i][1])


def test_good_and_bad_cover_all_records(spark):
    lines = spark.createDataFrame([(c[0],) for c in CASES], "value string")
    good, bad = parse_records(lines)
    assert good.count() + bad.count() == sum(len(c[1]) for c in CASES)
    assert "record" in good.columns and "value" not in good.columns
    assert set(bad.columns) == {"value", "item", "reason"}


def test_items_keep_their_place(spark):
    good, _ = parse_records(spark.createDataFrame([('[{"a":5},{"a":6}]',)], "value string"))
    got = good.select("item", F.variant_get("record", "$.a", "int")).collect()
    assert sorted(map(tuple, got)) == [(0, 5), (1, 6)]


def test_pretty_array_as_one_value(spark):
    text = '[\n  {"a": 1},\n  {"a": 2}\n]\n'
    good, bad = parse_records(spark.createDataFrame([(text,)], "value string"))
    assert good.count() == 2 and bad.count() == 0


def test_several_records_in_one_value_are_refused_not_cut(spark):
    _, bad = parse_records(spark.createDataFrame([('{"a":1}\n{"a":2}\n',)], "value string"))
    assert bad.count() == 1


def refuse_repeats(pairs):
    if len({k for k, _ in pairs}) != len(pairs):
        raise ValueError("repeated key")
    return dict(pairs)


def verdict(line):
    """What a strict JSON reader says of a line: kinds of its records, or that it is no JSON."""
    if not line.strip(" \t\r\n"):
        return []
    try:
        value = json.loads(line, object_pairs_hook=refuse_repeats, parse_constant=lambda c: int("no"))
    except ValueError:
        return ["refused"]
    items = value if isinstance(value, list) else [value]
    return ["good" if isinstance(i, dict) else "not an object" for i in items]


def test_broken_lines_against_a_strict_reader(spark):
    rng = random.Random(11)
    seeds = [
        '{"a":1,"b":[{"c":"x]"},2]}', '[{"a":1},{"b":null}]', '{"t":"}{","u":{"v":[]}}', "[]", '[[{"a":1}],{"b":true}]',
        ' {"a" : -1.5e3} ', '{"q":"\\"],["}', "[{},{}]", '{"a":1}{"b":2}', '{"a":1}],[{"b":2}', '{"a":1},{"b":2}',
    ]
    alphabet = list('{}[],:"1ae \t\\')
    lines = list(seeds)
    while len(lines) < 3000:
        chars = list(rng.choice(seeds))
        for _ in range(rng.randint(1, 3)):
            at, kind = rng.randrange(len(chars) + 1), rng.random()
            if kind < 0.4:
                chars.insert(at, rng.choice(alphabet))
            elif kind < 0.7 and at < len(chars):
                del chars[at]
            else:
                chars[at:at] = list(rng.choice(seeds))
        lines.append("".join(chars))
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    outcome = F.when(F.col("reason").isNull(), "good").when(F.col("reason") == "not an object", F.col("reason")).otherwise("refused")
    found = {}
    for row in parse_lines(df).select("i", "item", outcome.alias("o")).orderBy("i", "item").collect():
        found.setdefault(row.i, []).append(row.o)
    wrong = [(line, found.get(i, []), verdict(line)) for i, line in enumerate(lines) if found.get(i, []) != verdict(line)]
    assert not wrong, wrong[:5]
    assert sum(v == ["good"] for v in found.values()) > 50 and sum(v == ["refused"] for v in found.values()) > 500


def test_array_items_keep_their_digits(spark):
    text = '[{"a": 1.10, "b": 12345678901234567890.123450}, {"a": -0.0, "b": "x\\u00e9 ]},{ \\"q\\""}]'
    good, bad = parse_records(spark.createDataFrame([(text,)], "value string"))
    got = [tuple(r) for r in good.orderBy("item").select(F.variant_get("record", "$.a", "string"), F.variant_get("record", "$.b", "string")).collect()]
    assert got[0] == ("1.1", "12345678901234567890.12345") and got[1][1] == 'xé ]},{ "q"' and bad.count() == 0


def one_line_array(spark, root, records):
    """A file with one array of so many records in one line."""
    item = F.concat(F.lit('{"id":'), F.col("id").cast("string"), F.lit(',"note":"'), F.repeat(F.lit("]},{["), 20), F.lit('"}'))
    chunks = spark.range(records, numPartitions=1).select(item.alias("i")).toLocalIterator()
    with open(f"{root}/array.json", "w") as f:
        f.write("[")
        for k, row in enumerate(chunks):
            f.write(("," if k else "") + row.i)
        f.write("]\n")
    return f"{root}/array.json"


def test_an_array_beyond_one_variant_loads_whole(spark, root):
    n = 1_100_000
    path = one_line_array(spark, root, n)
    assert os.path.getsize(path) > VARIANT_BYTES
    parsed = parse_lines(spark.read.text(path))
    got = parsed.agg(F.count("*"), F.count("reason"), F.sum(F.variant_get("record", "$.id", "bigint")), F.max("item")).first()
    assert tuple(got) == (n, 0, n * (n - 1) // 2, n - 1)


def test_a_record_beyond_a_variant_has_its_own_reason(spark):
    long = F.concat(F.lit('{"a":"'), F.repeat(F.lit("x"), VARIANT_BYTES + 1), F.lit('"'))
    texts = [F.concat(long, F.lit("}")), F.concat(F.lit('[{"b":1},'), long, F.lit("}]")), F.concat(long, F.lit("} junk"))]
    for text, reason in zip(texts, [TOO_LARGE, TOO_LARGE, "malformed"]):
        parsed = parse_lines(spark.range(1).select(text.alias("value")))
        assert [r.reason for r in parsed.select("reason").collect()] == [reason]
