"""Normalising text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def code(column: Column) -> Column:
    """A code such as an instrument or a status: no padding, upper case."""
    return F.upper(F.trim(column))


def title(column: Column) -> Column:
    """A label such as a desk: no padding, each word capitalised (`FX` becomes `Fx`)."""
    return F.initcap(F.trim(column))
