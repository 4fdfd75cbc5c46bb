"""Records whose fields are not known beforehand, and how they differ from the contract.

Lines become variants, so a schema is found from all of them and not declared. A field counts by the
kind of its JSON value: string, number, boolean, object, array or null.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.operators.validate import FIELDS, TEXT_FIELDS
from blotter.sources.landing import is_one_object

_NUMBERS = ("notional", "price")
# What each field of the contract may be. Amounts and flags may come as text, which is cast.
EXPECTED: dict[str, tuple[str, ...]] = {
    name: ("string",) if name in TEXT_FIELDS
    else ("string", "number") if name in _NUMBERS
    else ("string", "boolean") if name == "is_anomaly"
    else ("string",)
    for name in FIELDS
}

ADDED, MISSING, RETYPED, AS_DECLARED = "added", "missing", "retyped", "as_declared"


def variants(lines: DataFrame) -> DataFrame:
    """Lines (`value`) as variants `v`, null where a line is not exactly one JSON object."""
    others = [c for c in lines.columns if c != "value"]
    parsed = F.when(is_one_object(F.col("value")), F.try_parse_json("value"))
    return lines.select(*others, parsed.alias("v"))


def infer_schema(records: DataFrame) -> str | None:
    """The schema of all records `v` together, as DDL; None without records."""
    found = records.agg(F.schema_of_variant_agg("v").alias("s")).first().s
    if found is None or found == "VOID":
        return None
    return found.replace("OBJECT<", "STRUCT<")


def infer(lines: DataFrame) -> DataFrame:
    """Records as columns, with the schema found in them. Values of different kinds stay variants."""
    records = variants(lines).where(F.col("v").isNotNull())
    schema = infer_schema(records)
    if schema is None or schema == "STRUCT<>":
        return records.select().limit(0)
    return records.select(F.variant_get("v", "$", schema).alias("r")).select("r.*")


def kind(value: Column) -> Column:
    """The kind of a variant."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    whole = F.when(name.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "number")
    return whole.when(name == "VOID", "null").otherwise(F.lower(name))


def field_kinds(records: DataFrame) -> DataFrame:
    """Per field and kind of its values the number of records, over all records `v`."""
    fields = records.select("v").lateralJoin(records.sparkSession.tvf.variant_explode(F.col("v").outer()))  # none of a null
    return fields.groupBy(F.col("key").alias("field"), kind(F.col("value")).alias("kind")).agg(
        F.count(F.lit(1)).alias("n_records")
    )


def drift(records: DataFrame, expected: Mapping[str, tuple[str, ...]] = EXPECTED) -> DataFrame:
    """How the fields of the records differ from the contract, one row per field of either.

    A field that no record of the contract's has is `added`; one that is not in every record is
    `missing`; one with values of a kind that is not expected, null aside, is `retyped`. `kinds` has
    the kinds met, `n_present` and `n_unexpected` how many records have it and how many as something else.
    """
    spark = records.sparkSession
    names = F.array(*[F.struct(F.lit(n).alias("field"), F.array(*map(F.lit, k)).alias("may")) for n, k in expected.items()])
    contract = spark.range(1).select(F.inline(names))
    total = records.agg(F.count("v")).scalar()
    met = (
        field_kinds(records)
        .join(F.broadcast(contract), "field", "left")  # a row per declared field
        .groupBy("field")
        .agg(
            F.sum("n_records").alias("n_present"),
            F.sum(
                F.when((F.col("kind") != "null") & ~F.array_contains("may", F.col("kind")), F.col("n_records"))
                .otherwise(0)
            ).alias("n_unexpected"),
            F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"),
        )
    )
    joined = contract.join(met, "field", "full")
    present = F.coalesce("n_present", F.lit(0).cast("bigint"))
    unexpected = F.coalesce("n_unexpected", F.lit(0).cast("bigint"))
    status = (
        F.when(F.col("may").isNull(), ADDED)
        .when(present < total, MISSING)
        .when(unexpected > 0, RETYPED)
        .otherwise(AS_DECLARED)
    )
    return joined.select(
        "field",
        status.alias("status"),
        present.alias("n_present"),
        (total - present).alias("n_missing"),
        F.when(F.col("may").isNotNull(), unexpected).alias("n_unexpected"),
        F.coalesce("kinds", F.lit("")).alias("kinds"),
    )
