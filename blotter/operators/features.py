"""Derived columns of a trade: conversion, exposure, bands, activity and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.config import Config
from blotter.functions import clock, money, risk
from blotter.operators.segments import SEGMENT, assign_segments

TRADER_HOUR = ("trader_id", "trade_date", "trade_hour")
TIME_ORDER = ("trade_timestamp", "trade_id")


# A rate table of at most this many rows may be broadcast.
BROADCAST_RATES = 10_000


def fx_table(spark: SparkSession, cfg: Config) -> DataFrame:
    """The configured rates as a dimension (instrument, rate), broadcast if they are few."""
    rows = [
        F.struct(F.lit(name).alias("instrument"), F.lit(rate).cast(money.RATE).alias("rate"))
        for name, rate in cfg.fx_rates.items()
    ]
    table = spark.range(1).select(F.inline(F.array(*rows)))
    return F.broadcast(table) if len(rows) <= BROADCAST_RATES else table


def convert_with(trades: DataFrame, rates: DataFrame) -> DataFrame:
    """Add `notional_eur` from a rate table (instrument, rate); a missing rate counts as 1.

    Instruments are compared in upper case. Two rates for one instrument are an error, raised when
    the rates are read; they would count every trade twice. Spark broadcasts a small table.
    """
    once = F.when(F.count(F.lit(1)) == 1, F.max("rate")).otherwise(
        F.raise_error(F.concat(F.lit("more than one rate for "), F.col("_fx_key"))).cast(money.RATE)
    )
    keyed = (
        rates.where(F.col("instrument").isNotNull())
        .select(F.upper("instrument").alias("_fx_key"), "rate")
        .groupBy("_fx_key")
        .agg(once.alias("_fx_rate"))
    )
    joined = trades.join(keyed, F.upper("instrument") == F.col("_fx_key"), "left")
    eur = money.in_eur(F.col("notional"), F.col("_fx_rate"))
    return joined.withColumn(
        "notional_eur", F.when(F.col("instrument").isNotNull(), eur)
    ).drop("_fx_key", "_fx_rate")


def convert(trades: DataFrame, cfg: Config) -> DataFrame:
    """Add `notional_eur` from the configured rates, which are few enough to be literals."""
    rate = money.rate_for(F.col("instrument"), cfg.fx_rates)
    eur = money.in_eur(F.col("notional"), rate)
    return trades.withColumn("notional_eur", F.when(F.col("instrument").isNotNull(), eur))


def add_trade_features(
    trades: DataFrame, cfg: Config, rates: DataFrame | None = None
) -> DataFrame:
    """Columns that depend on the trade alone. `rates` replaces the configured rates."""
    converted = convert(trades, cfg) if rates is None else convert_with(trades, rates)
    eur = F.col("notional_eur")
    return converted.withColumns(
        {
            "signed_notional_eur": money.signed(eur, F.col("direction")),
            "is_large_trade": risk.is_large(eur, cfg),
            "risk_tier": risk.tier(eur, cfg),
            "time_of_day": clock.time_of_day(F.col("trade_hour")),
        }
    )


def add_activity(trades: DataFrame, cfg: Config) -> DataFrame:
    """Add trades_in_hour, velocity_flag and trader_daily_notional_run.

    A busy trader-hour is cut into segments, none of which is more than a task can hold. The
    wide rows meet in windows by trader, date, hour and segment; what spans several tasks (the
    count of an hour, the running total up to a segment) comes from sums per segment, which are
    combined before their own, small shuffle.
    """
    rows = assign_segments(trades, TRADER_HOUR, TIME_ORDER, cfg)
    segment = (*TRADER_HOUR, SEGMENT)

    sums = rows.groupBy(*segment).agg(
        F.count("trade_id").alias("_trades"), F.sum("notional_eur").alias("_eur")
    )
    earlier_today = (
        Window.partitionBy("trader_id", "trade_date")
        .orderBy("trade_hour", SEGMENT)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    per_segment = sums.select(
        *segment,
        F.sum("_eur").over(earlier_today).alias("_before"),
        F.sum("_trades").over(Window.partitionBy(*TRADER_HOUR)).alias("_in_hour"),
    )

    up_to_row = (
        Window.partitionBy(*segment)
        .orderBy(*TIME_ORDER)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = rows.withColumn("_inside", F.sum("notional_eur").over(up_to_row))
    joined = inside.join(per_segment, list(segment), "left")
    run = F.coalesce(F.col("_before") + F.col("_inside"), F.col("_inside"), F.col("_before"))
    return joined.withColumns(
        {
            "trades_in_hour": F.col("_in_hour").cast("int"),
            "velocity_flag": F.col("_in_hour") > cfg.velocity_max_trades,
            "trader_daily_notional_run": run.try_cast(money.RUNNING),
        }
    ).drop(SEGMENT, "_before", "_inside", "_in_hour")


def add_alerts(trades: DataFrame) -> DataFrame:
    level = risk.alert_level(F.col("is_anomaly"), F.col("velocity_flag"))
    return trades.withColumn("alert_level", level)


def engineer(trades: DataFrame, cfg: Config, rates: DataFrame | None = None) -> DataFrame:
    """All derived Silver columns."""
    return add_alerts(add_activity(add_trade_features(trades, cfg, rates), cfg))
