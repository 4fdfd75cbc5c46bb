"""Landing files: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators.validate import FIELDS, MALFORMED, NOT_TEXT, RAW, TEXT_FIELDS

_CORRUPT = "_corrupt_record"
# Values stay text here; the validation casts them.
_SCHEMA = ", ".join(f"{name} STRING" for name in (*FIELDS, _CORRUPT))
_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "allowSingleQuotes": "false",
}

# The normal line: one object without braces inside it.
_PLAIN_OBJECT = r"^\s*\{[^{}]*\}\s*$"
# What a JSON number, boolean or nested value looks like once it is text.
_LOOKS_UNQUOTED = r"^(-?\d+(\.\d+)?([eE][+-]?\d+)?|true|false)$|^[\[{]"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def is_one_object(line: Column) -> Column:
    """Whether the whole line is one JSON object.

    The record parser stops after the first value, so `{...} rest` passes it. Inside brackets
    the rest is an error. Only lines that are not a plain object need this second parse.
    """
    items = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]"))).cast("array<variant>")
    alone = F.ltrim(line).startswith("{") & F.coalesce(F.size(items) == 1, F.lit(False))
    return F.when(line.rlike(_PLAIN_OBJECT), True).otherwise(alone)


def _not_text(line: Column, name: str, value: Column) -> Column:
    """The name of a text field whose JSON value was not a string, else null."""
    found = F.try_variant_get(F.try_parse_json(line), f"$.{name}", "variant")
    is_string = F.coalesce(F.schema_of_variant(found) == "STRING", F.lit(False))
    return F.when(value.rlike(_LOOKS_UNQUOTED) & ~is_string, F.lit(name))


def parse(lines: DataFrame) -> DataFrame:
    """Lines (`value`) to records: the twelve fields as text, and what was wrong with the line.

    Blank lines are skipped. A line that is not exactly one JSON object is marked malformed. Other
    columns of the lines, such as their load, stay beside the record.
    """
    line = F.col("value")
    others = [name for name in lines.columns if name != "value"]
    parsed = lines.where(F.trim(line) != "").select(
        *others, line.alias(RAW), F.from_json(line, _SCHEMA, _OPTIONS).alias("j")
    )
    raw = F.col(RAW)
    broken = F.col("j").isNull() | F.col(f"j.{_CORRUPT}").isNotNull() | ~is_one_object(raw)
    wrong_type = [_not_text(raw, name, F.col(f"j.{name}")) for name in TEXT_FIELDS]
    return parsed.select(
        *others,
        RAW,
        *[F.col(f"j.{name}").alias(name) for name in FIELDS],
        broken.alias(MALFORMED),
        F.array_compact(F.array(*wrong_type)).alias(NOT_TEXT),
    )
