"""Record validation as column predicates.

A record is checked by the same casts the cleaning step applies later, so whatever passes
here also survives there: nothing is lost between Bronze and Silver without a reason.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.money import AMOUNT, PRICE, percent

# The record contract.
TEXT_FIELDS = ("trade_id", "trader_id", "instrument", "desk", "region", "counterparty")
FIELDS = (
    "trade_id", "trader_id", "instrument", "direction", "notional", "price",
    "desk", "region", "counterparty", "status", "trade_timestamp", "is_anomaly",
)
CAST_TO = {
    "notional": AMOUNT,
    "price": PRICE,
    "trade_timestamp": "timestamp",
    "is_anomaly": "boolean",
}
DIRECTIONS = ("BUY", "SELL")
STATUSES = ("EXECUTED", "CANCELLED", "PENDING")
TRADER_PREFIX = "TDR_"

# Columns a parsed landing line brings along besides the twelve fields.
RAW, MALFORMED, NOT_TEXT = "_raw", "_malformed", "_not_text"
VALID, ERRORS = "_valid", "_errors"
LOAD = "_load_id"


def _field_rules() -> list[tuple[Column, str]]:
    """When a rule is broken, and what to say then. An unknown outcome is not a break."""
    rules = [(F.col(name).isNull(), f"{name}: missing") for name in FIELDS]
    for name, kind in CAST_TO.items():
        lost = F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
        rules.append((lost, f"{name}: not a {kind}"))
    return rules + [
        (~F.col("direction").isin(*DIRECTIONS), "direction: not BUY or SELL"),
        (~F.col("status").isin(*STATUSES), "status: unknown value"),
        (F.col("notional").try_cast(AMOUNT) <= 0, "notional: not positive"),
        (
            ~F.col("trader_id").startswith(TRADER_PREFIX),
            f"trader_id: does not start with {TRADER_PREFIX}",
        ),
    ]


def check(records: DataFrame) -> DataFrame:
    """Add `_valid`, and `_errors` with every broken rule of a record that is not.

    `_valid` is one boolean expression, so a filter on it stays in generated code; the list is
    only built for the records that need it.
    """
    rules = _field_rules()
    any_broken = reduce(or_, [broken for broken, _ in rules])
    errors = F.array_compact(F.array(*[F.when(broken, F.lit(text)) for broken, text in rules]))
    if MALFORMED in records.columns:
        wrong_type = F.transform(NOT_TEXT, lambda name: F.concat(name, F.lit(": not text")))
        malformed = F.col(MALFORMED)
        any_broken = malformed | (F.size(NOT_TEXT) > 0) | any_broken
        errors = F.when(malformed, F.array(F.lit("malformed_json"))).otherwise(
            F.concat(errors, wrong_type)
        )
    is_valid = ~F.coalesce(any_broken, F.lit(False))
    return records.select(
        "*",
        is_valid.alias(VALID),
        F.when(is_valid, F.array().cast("array<string>")).otherwise(errors).alias(ERRORS),
    )


def valid(checked: DataFrame) -> DataFrame:
    """The accepted records, their twelve fields as they arrived."""
    return checked.where(F.col(VALID)).select(*FIELDS)


def quarantined(checked: DataFrame) -> DataFrame:
    """The rejected records with every reason in `_error`, and the raw line and load if there are."""
    raw = [name for name in (LOAD, RAW) if name in checked.columns]
    reasons = F.array_join(ERRORS, "; ").alias("_error")
    return checked.where(~F.col(VALID)).select(*raw, *FIELDS, reasons)


def summary(checked: DataFrame) -> DataFrame:
    """One row: totals and percentages of the validation."""
    is_valid = F.col(VALID)
    counted = checked.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_valid).alias("valid"),
        F.count_if(~is_valid).alias("quarantined"),
    )
    total = F.col("total")
    return counted.withColumns(
        {
            "valid_pct": percent(F.col("valid"), total),
            "quarantined_pct": percent(F.col("quarantined"), total),
        }
    )
