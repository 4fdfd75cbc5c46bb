"""The column functions as SQL functions, for queries and views written in SQL.

They are SQL expressions that Spark puts in place of the call: nothing runs in Python, and filters and
column pruning work through them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from blotter.config import Config
from blotter.functions.money import AMOUNT, RATE
from blotter.sources.tables import SILVER_REQUIRED

# Wide enough for any amount of cents with six decimals.
CENTS = "decimal(30,6)"
EUROS = "decimal(30,2)"


def _rates(cfg: Config) -> str:
    whens = " ".join(f"WHEN '{name}' THEN {rate}BD" for name, rate in cfg.fx_rates.items())
    return f"CASE upper(instrument) {whens} END" if whens else "NULL"


def scalar_functions(cfg: Config) -> dict[str, str]:
    """Name to the rest of its CREATE FUNCTION statement."""
    return {
        "cents_to_euros": f"(cents {CENTS}) RETURNS {EUROS} RETURN round(cents / 100.0BD, 2)",
        "fx_rate": f"(instrument STRING) RETURNS {RATE} RETURN {_rates(cfg)}",
        "fx_to_eur": (
            f"(notional {AMOUNT}, instrument STRING) RETURNS {AMOUNT} "
            "RETURN CASE WHEN instrument IS NOT NULL THEN round(notional * coalesce(fx_rate(instrument), 1BD), 2) END"
        ),
    }


def register(spark: SparkSession, cfg: Config, trades: str | None = None) -> list[str]:
    """Create the functions in the session; with the name of a view of trades also the table function
    `trades_between(first, last)`, its rows of some dates. Returns the names.
    """
    functions = scalar_functions(cfg)
    if trades is not None:
        columns = ", ".join(SILVER_REQUIRED)
        functions["trades_between"] = (
            f"(first DATE, last DATE) RETURNS TABLE RETURN SELECT {columns} FROM {trades} "
            "WHERE trade_date BETWEEN trades_between.first AND trades_between.last"
        )
    for name, rest in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{rest}")
    return list(functions)
