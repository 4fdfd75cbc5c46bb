"""Decimal money arithmetic. Nothing here goes through a floating-point value."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(24,4)"
RUNNING = "decimal(28,4)"
PRICE = "decimal(18,6)"
RATE = "decimal(10,6)"
TOTAL = "decimal(34,4)"
AVERAGE = "decimal(28,8)"


def rate_for(instrument: Column, rates: Mapping[str, Decimal]) -> Column:
    """The rate of an instrument as a literal lookup, null when it has none."""
    if not rates:
        return F.lit(None).cast(RATE)
    pairs = ((F.lit(name), F.lit(rate).cast(RATE)) for name, rate in rates.items())
    return F.try_element_at(F.create_map(*chain.from_iterable(pairs)), F.upper(instrument))


def in_eur(notional: Column, rate: Column) -> Column:
    """Amount times rate, rounded half up to cents. An unknown rate counts as 1."""
    exact = notional.try_cast(AMOUNT) * F.coalesce(rate.cast(RATE), F.lit(1).cast(RATE))
    return F.round(exact, 2).try_cast(AMOUNT)


def signed(amount: Column, direction: Column) -> Column:
    """A buy counts as a gain of exposure, a sell as a loss, anything else as none."""
    return (
        F.when(direction == "BUY", amount)
        .when(direction == "SELL", F.negative(amount))
        .otherwise(F.lit(0).cast(AMOUNT))
    )


def percent(part: Column, whole: Column) -> Column:
    """`part` as a percentage of `whole` with two decimals; null when `whole` is zero."""
    hundred = F.lit(Decimal("100.0"))
    return F.round(part * hundred / F.nullif(whole, F.lit(0)), 2)


def cents_to_euros(cents: Column) -> Column:
    """An amount in cents as euros, rounded half up to cents."""
    return F.round(cents / F.lit(Decimal("100.0")), 2)
