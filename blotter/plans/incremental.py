"""Silver, the cube and the marts, kept up to date date by date.

Everything Silver derives from other trades (the count of an hour, the total of a day) stays within a
date, and every measure of the marts merges over dates. So a load only touches the dates its trades
fall on: those partitions of Silver, of the state and of the daily mart are written anew, the rest
stays as it is. The two marts over all dates are rolled up from the state, which has a row per
date and group instead of the trades.

State, below `gold_state/` and partitioned by date:

* `exposure`: cells per trader, desk and region.
* `instruments`: cells per instrument and desk.
* `seen`: per instrument and desk the traders and regions of the date, as bitmaps over numbers
  from the table `numbers`, which only grows.

A run that fails is repeated from the same mark: dates are replaced, never added to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.config import Config
from blotter.operators import bitmaps, cleaning
from blotter.operators.features import engineer
from blotter.plans import gold
from blotter.plans.silver import SILVER_DDL, conform
from blotter.sinks import tables as sink
from blotter.sources.tables import read_table, table_exists

# The columns whose values are numbered, and what the instruments mart calls their counts.
SEEN = {"trader_id": "unique_traders", "region": "active_regions"}

EXPOSURE_KEYS = ("trade_date", "trader_id", "desk", "region")
INSTRUMENT_KEYS = ("trade_date", "instrument", "desk")


def state_path(cfg: Config, name: str) -> str:
    return f"{cfg.root}/gold_state/{name}"


def changed_dates(bronze: DataFrame, since=None) -> DataFrame:
    """The trade dates of the rows ingested after a time; of all rows without one."""
    rows = bronze if since is None else bronze.where(F.col("_ingested_at") > F.lit(since))
    return cleaning.clean(rows).select("trade_date").where(F.col("trade_date").isNotNull()).distinct()


def silver_of(bronze: DataFrame, dates: Sequence, cfg: Config) -> DataFrame:
    """Silver's rows of some dates, from all of Bronze's rows of those dates."""
    cleaned = cleaning.clean(bronze).where(F.col("trade_date").isin(list(dates)))
    return conform(engineer(cleaning.drop_cancelled(cleaned), cfg))


def number_values(trades: DataFrame, known: DataFrame | None) -> DataFrame:
    """Numbers for the values of the numbered columns that have none yet: `field`, value, number."""
    parts = []
    for field in SEEN:
        old = None if known is None else known.where(F.col("field") == field)
        fresh = bitmaps.numbered(trades.select(field), old)
        parts.append(fresh.select(F.lit(field).alias("field"), "value", "number"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def seen(trades: DataFrame, numbers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per group and field the set of its values' numbers."""
    parts = None
    for field in SEEN:
        own = numbers.where(F.col("field") == field).select(F.col("value").alias("_value"), "number")
        with_number = trades.join(own, F.col(field) == F.col("_value"))
        found = bitmaps.sets(with_number, keys).withColumn("field", F.lit(field))
        parts = found if parts is None else parts.unionByName(found)
    return parts


def distinct_counts(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per group the number of different values of each field, over all dates."""
    counted = bitmaps.sizes(sets, [*keys, "field"], "n")
    return counted.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("field") == field, F.col("n"))), F.lit(0)).alias(name)
            for field, name in SEEN.items()
        ]
    )


def instruments_from_state(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """The instruments mart from its state."""
    keys = INSTRUMENT_KEYS[1:]
    counts = distinct_counts(sets, keys).select(
        *[F.col(key).alias(f"_{key}") for key in keys], *[F.col(n).alias(f"_{n}") for n in SEEN.values()]
    )
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    totals = gold.instrument_totals(cells, distinct=False).join(counts, same, "left")
    found = {name: F.coalesce(f"_{name}", F.lit(0).cast("bigint")) for name in SEEN.values()}
    names = gold.INSTRUMENT_TOTALS
    return gold.with_shares_and_ranks(totals.withColumns(found).select(*names))


def _state(spark: SparkSession, cfg: Config, name: str) -> DataFrame:
    return read_table(spark, state_path(cfg, name), cfg)


def _mark(spark: SparkSession, cfg: Config):
    """The ingestion time up to which Bronze has been taken in."""
    if not table_exists(spark, state_path(cfg, "mark"), cfg):
        return None
    return _state(spark, cfg, "mark").agg(F.max("up_to")).first()[0]


def refresh(spark: SparkSession, bronze: DataFrame, cfg: Config) -> dict:
    """Take in what was ingested since the last run. Returns the dates that were written anew."""
    since = _mark(spark, cfg)
    latest = bronze.agg(F.max("_ingested_at")).first()[0]
    # As many as there are days in a load.
    dates = sorted(row.trade_date for row in changed_dates(bronze, since).collect())
    if dates:
        sink.replace_dates(silver_of(bronze, dates, cfg), cfg.silver_path, cfg)
        _refresh_state(spark, dates, cfg)
        exposure = gold.risk_exposure(_state(spark, cfg, "exposure"), cfg)
        instruments = instruments_from_state(
            _state(spark, cfg, "instruments"), _state(spark, cfg, "seen")
        )
        sink.write_gold(exposure, "mart_risk_exposure", cfg)
        sink.write_gold(instruments, "mart_top_instruments", cfg)
    if latest is not None and latest != since:
        sink.overwrite(spark.range(1).select(F.lit(latest).alias("up_to")), state_path(cfg, "mark"), cfg)
    return {"dates": dates}


def _refresh_state(spark: SparkSession, dates: Sequence, cfg: Config) -> None:
    silver = read_table(spark, cfg.silver_path, cfg, SILVER_DDL)
    trades = gold.enriched(gold.staging(silver.where(F.col("trade_date").isin(list(dates)))), cfg)
    path = state_path(cfg, "numbers")
    known = _state(spark, cfg, "numbers") if table_exists(spark, path, cfg) else None
    sink.append(number_values(trades, known), path, cfg)
    numbers = _state(spark, cfg, "numbers")
    with sink.staged(gold.activity_cube(trades), cfg) as (cube, _):
        sink.replace_dates(gold.daily_volume(cube), cfg.gold_path("mart_daily_volume"), cfg)
        sink.replace_dates(gold.rolled_up(cube, EXPOSURE_KEYS), state_path(cfg, "exposure"), cfg)
        sink.replace_dates(gold.rolled_up(cube, INSTRUMENT_KEYS), state_path(cfg, "instruments"), cfg)
        sink.replace_dates(seen(cube, numbers, INSTRUMENT_KEYS), state_path(cfg, "seen"), cfg)
