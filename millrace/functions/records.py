"""Strict record parse: text lines in, one VARIANT per record out, bad records kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Why a record was refused.
MALFORMED = "malformed"
TRAILING = "trailing data"
NOT_OBJECT = "not an object"
TOO_LARGE = "too large"
NO_CHANGE_TIME = "no change time"

RECORD = "record"
ITEM = "item"
REASON = "reason"

JSON_SPACE = " \t\r\n"


def without_lead(line: Column) -> Column:
    """The line from its first character that is not JSON white space; empty for a blank line."""
    return F.ltrim(line, F.lit(JSON_SPACE))


# Fixed value: the most bytes a VARIANT holds.
VARIANT_BYTES = 128 * 1024 * 1024

# JSON as the standard has it; a text may be as long as a string can be.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "maxStringLen": "2147483647"}

# Follows the text inside the brackets it is parsed in; a line would have to hold it to pass as whole.
END_MARK = "c1f7a0de-end-of-line-6b29"


def parse_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """One row per record of every non-blank line, good and bad together.

    Adds ``record`` (VARIANT), ``item`` (position within an outer array) and
    ``reason`` (NULL for a good record). An outer array is stripped; an empty one
    holds no record. The parser stops at the end of the first value, so the text is
    parsed as ``[text, mark]``: only a text that is one whole value leaves the mark in
    second place.

    An array is cut into its items while it is read and each item becomes a VARIANT of its
    own, so an array may be far larger than a VARIANT. An item or a line that is sound
    JSON but more than a VARIANT holds is refused as too large, an array with its other items.
    """
    text = F.col(line_col)
    wrapped = F.concat(F.lit("["), text, F.lit(f',"{END_MARK}"]'))
    is_array = F.col("_lead") == "["
    found = (
        lines.filter(without_lead(text) != "")
        .select("*", F.substring(without_lead(text), 1, 1).alias("_lead"))
        .select(
            "*",
            F.when(~is_array, F.try_variant_get(F.try_parse_json(wrapped), "$", "array<variant>")).alias("_values"),
            # of an array only its end is looked at here; its text comes back in one piece
            F.when(is_array, F.from_json(wrapped, "array<string>", STRICT)).alias("_ends"),
            F.when(is_array, F.from_json(text, "array<variant>", STRICT)).alias("_items"),
        )
    )
    values, ends = F.col("_values"), F.col("_ends")
    mark = F.when(is_array, F.get(ends, F.lit(1))).otherwise(F.try_variant_get(F.get(values, F.lit(1)), "$", "string"))
    size = F.when(is_array, F.size(ends)).otherwise(F.size(values))
    whole = F.coalesce((size == 2) & (mark == END_MARK), F.lit(False))
    none = F.when(is_array, ends.isNull()).otherwise(values.isNull())
    shape = (
        F.when(none, F.when(~is_array & _beyond_variant(text), TOO_LARGE).otherwise(MALFORMED))
        .when(~whole, TRAILING)
        # all of it is JSON, but some item is no VARIANT
        .when(is_array & F.col("_items").isNull(), F.when(_has_large_item(text), TOO_LARGE).otherwise(MALFORMED))
    )
    items = (
        F.when(F.col("_shape").isNotNull(), F.array(F.lit(None).cast("variant")))
        .when(is_array, F.col("_items"))
        .otherwise(F.array(F.get(values, F.lit(0))))
    )
    # The first character tells an object line apart; only array items need a look inside.
    is_object = F.when(
        is_array, F.try_variant_get(F.col(RECORD), "$", "map<string,variant>").isNotNull()
    ).otherwise(F.col("_lead") == "{")
    return (
        found.withColumn("_shape", shape)
        .select(*lines.columns, "_lead", "_shape", F.posexplode(items).alias(ITEM, RECORD))
        .withColumn(REASON, F.coalesce("_shape", F.when(~is_object, NOT_OBJECT)))
        .drop("_lead", "_shape")
    )


def _beyond_variant(text: Column) -> Column:
    """Whether a text no VARIANT was made of is one sound JSON value of more bytes than a VARIANT holds."""
    ends = F.from_json(F.concat(F.lit("["), text, F.lit(f',"{END_MARK}"]')), "array<string>", STRICT)
    return (F.octet_length(text) > VARIANT_BYTES) & F.coalesce((F.size(ends) == 2) & (F.get(ends, F.lit(1)) == END_MARK), F.lit(False))


def _has_large_item(text: Column) -> Column:
    """Whether an item of a sound array has more bytes than a VARIANT holds."""
    return F.exists(F.from_json(text, "array<string>", STRICT), lambda item: F.octet_length(item) > VARIANT_BYTES)


def parse_records(lines: DataFrame, line_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: good rows carry ``record``; bad rows keep the text and a reason."""
    parsed = parse_lines(lines, line_col)
    return split_parsed(parsed, line_col)


def split_parsed(parsed: DataFrame, line_col: str = "value") -> tuple[DataFrame, DataFrame]:
    good = parsed.filter(F.col(REASON).isNull()).drop(line_col, REASON)
    bad = parsed.filter(F.col(REASON).isNotNull()).drop(RECORD)
    return good, bad
