"""Every registered query: an operator of the package over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DecimalType, IntegerType, ShortType

from blotter.config import Config
from blotter.functions import money
from blotter.functions import sql as sql_functions
from blotter.operators import (
    cleaning,
    features,
    insert_only,
    profile,
    quality,
    validate,
    zorder,
)
from blotter.plans import gold, incremental, jobs
from blotter.plans.silver import silver
from blotter.session import checkpoint_folder, checkpointed, prepare
from blotter.sinks import tables as sink
from blotter.sources import drift, landing, tables, trades_view
from blotter.streaming import alerts
from blotter.streaming.velocity import velocity_counts

# The sparse test data never reach ten trades of a trader in an hour.
CFG = replace(Config(root="unused"), velocity_max_trades=1)

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as double and integers as bigint, which both engines print alike."""
    whole = (ByteType, ShortType, IntegerType)
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, whole):
            column = column.cast("bigint")
        out.append(column.alias(field.name))
    return df.select(*out)


# ---- layers over the test tables ----------------------------------------------------------


def _trades(spark, sf_dir):
    return trades_view.trades(spark, sf_dir)


def _checked(spark, sf_dir):
    return validate.check(trades_view.faulty_records(spark, sf_dir))


def _clean(spark, sf_dir):
    return cleaning.drop_cancelled(cleaning.clean(trades_view.bronze(spark, sf_dir)))


def _featured(spark, sf_dir):
    """Columns that depend on the trade alone, without the activity windows."""
    return features.add_trade_features(_clean(spark, sf_dir), CFG)


def _active(spark, sf_dir):
    return features.add_activity(_featured(spark, sf_dir), CFG)


def _silver(spark, sf_dir):
    return silver(trades_view.bronze(spark, sf_dir), CFG)


def _staged(spark, sf_dir):
    return gold.staging(_silver(spark, sf_dir))


def _enriched(spark, sf_dir):
    return gold.enriched(_staged(spark, sf_dir), CFG)


def _cube(spark, sf_dir):
    return gold.activity_cube(_enriched(spark, sf_dir))


def _mart(name):
    return lambda spark, sf_dir: gold.MARTS[name](_cube(spark, sf_dir), CFG)


def _sorted(name):
    """The keys of a mart with their place in reading order."""
    return lambda spark, sf_dir: gold.with_position(_mart(name)(spark, sf_dir), name).select(
        *gold.GRAINS[name], "position"
    )


def _tables(spark, sf_dir):
    staged = _staged(spark, sf_dir)
    full = gold.enriched(staged, CFG)
    cube = checkpointed(gold.activity_cube(full))  # for all marts
    marts = {name: build(cube, CFG) for name, build in gold.MARTS.items()}
    return {"stg_trades": staged, "int_trade_enriched": full, **marts}


# ---- queries ------------------------------------------------------------------------------


def bronze_scan(spark, sf_dir):
    return _trades(spark, sf_dir)


def bronze_validate(spark, sf_dir):
    checked = _checked(spark, sf_dir)
    return checked.select(
        "trade_id",
        F.col(validate.VALID).alias("is_valid"),
        F.array_join(validate.ERRORS, "; ").alias("error"),
    )


def bronze_merge_insert(spark, sf_dir):
    """Everything but the pending trades is there already; then all trades arrive, twice."""
    rows = _trades(spark, sf_dir)
    target = rows.where(F.col("status") != "PENDING").withColumn("_source", F.lit("earlier"))
    arriving = rows.withColumn("_source", F.lit("arriving"))
    batch = arriving.unionByName(arriving)
    fresh = insert_only.new_rows(batch, target, "trade_id", F.col("trade_timestamp"))
    return target.unionByName(fresh)


def bronze_insert_pruned(spark, sf_dir):
    """What is inserted where all arriving ids fall in one of Bronze's 16 partitions."""
    rows = _trades(spark, sf_dir).withColumn(insert_only.PREFIX, insert_only.prefix(F.col("trade_id"), 1))
    path = f"{checkpoint_folder(spark)}/queries/{uuid4().hex}"
    rows.where(F.col("status") != "PENDING").write.partitionBy(insert_only.PREFIX).parquet(path)
    batch = rows.where(F.col(insert_only.PREFIX) == "7")
    target = insert_only.reachable(spark.read.parquet(path), batch, "trade_id", 1)
    return insert_only.new_rows(batch, target, "trade_id", F.col("trade_timestamp"))


def silver_clean(spark, sf_dir):
    return cleaning.clean(trades_view.faulty_records(spark, sf_dir))


def silver_not_cancelled(spark, sf_dir):
    return cleaning.drop_cancelled(silver_clean(spark, sf_dir))


def fx_conversion(spark, sf_dir):
    converted = features.convert_with(_clean(spark, sf_dir), features.fx_table(spark, CFG))
    return converted.select("trade_id", "instrument", "notional", "notional_eur")


def exposure_tier(spark, sf_dir):
    full = gold.enriched(_featured(spark, sf_dir), CFG)
    return full.select("trade_id", "signed_notional_eur", "exposure_tier")


def calendar_features(spark, sf_dir):
    full = gold.enriched(_featured(spark, sf_dir), CFG)
    return full.select(
        "trade_id", "direction_multiplier", "day_of_week", "day_name", "week_number",
        "is_weekend", "is_market_hours",
    )


def silver_zorder(spark, sf_dir):
    """The clustering key of Silver's two columns and of one with more values than buckets."""
    rows = _clean(spark, sf_dir)
    cuts = {
        name: zorder.quantile_cuts(rows, name) for name in (*sink.SILVER_ZORDER, "counterparty")
    }
    buckets = [zorder.bucket_of(F.col(name), c).alias(f"{name}_bucket") for name, c in cuts.items()]
    return rows.select("trade_id", *buckets, zorder.z_key(cuts).alias("z_key"))


def cents_to_euros(spark, sf_dir):
    """The price taken as cents, so that the rounding shows."""
    cents = F.col("price")
    return _trades(spark, sf_dir).select(
        "trade_id", cents.alias("cents"), money.cents_to_euros(cents).alias("euros")
    )


def cents_to_euros_sql(spark, sf_dir):
    """The same through the SQL function."""
    sql_functions.register(spark, CFG)
    sink.as_view(_trades(spark, sf_dir), "priced_trades")
    return spark.sql("SELECT trade_id, price AS cents, cents_to_euros(price) AS euros FROM priced_trades")


def fx_conversion_sql(spark, sf_dir):
    sql_functions.register(spark, CFG)
    sink.as_view(_clean(spark, sf_dir), "clean_trades_view")
    return spark.sql(
        "SELECT trade_id, instrument, notional, fx_to_eur(notional, instrument) AS notional_eur "
        "FROM clean_trades_view"
    )


def trades_between(spark, sf_dir):
    """A week of trades per desk, by the table function over Silver."""
    sink.as_view(_silver(spark, sf_dir), "silver_view")
    sql_functions.register(spark, CFG, "silver_view")
    return spark.sql(
        "SELECT trade_date, desk, count(*) AS trades, sum(notional_eur) AS eur "
        "FROM trades_between(DATE'2024-01-08', DATE'2024-01-14') GROUP BY trade_date, desk"
    )


def buy_sell_volume(spark, sf_dir):
    return _mart("mart_top_instruments")(spark, sf_dir).select(
        "instrument", "desk", "buy_volume_eur", "sell_volume_eur", "net_volume_eur"
    )


def conditional_counts(spark, sf_dir):
    return _mart("mart_daily_volume")(spark, sf_dir).select(
        "trade_date", "desk", "instrument", "region", "buy_count", "sell_count",
        "large_trade_count", "anomaly_count", "velocity_flagged_count", "critical_alert_count",
        "warning_alert_count", "market_hours_count", "after_hours_count",
    )


def worst_alert(spark, sf_dir):
    return _mart("mart_risk_exposure")(spark, sf_dir).select(
        "trader_id", "desk", "region", "has_critical_alert", "has_warning_alert",
        "worst_alert_level",
    )


def distinct_counts(spark, sf_dir):
    return _mart("mart_top_instruments")(spark, sf_dir).select(
        "instrument", "desk", "unique_traders", "active_days", "active_regions"
    )


def _state(spark, sf_dir):
    """The instruments mart's state per date: cells, and traders and regions as bitmaps."""
    cube = checkpointed(_cube(spark, sf_dir))
    numbers = checkpointed(incremental.number_values(cube, None))
    cells = gold.rolled_up(cube, incremental.INSTRUMENT_KEYS)
    return cells, incremental.seen(cube, numbers, incremental.INSTRUMENT_KEYS)


def distinct_by_bitmaps(spark, sf_dir):
    """Distinct traders and regions, united over the bitmaps of the dates."""
    _, sets = _state(spark, sf_dir)
    return incremental.distinct_counts(sets, ("instrument", "desk"))


def mart_top_instruments_merged(spark, sf_dir):
    return incremental.instruments_from_state(*_state(spark, sf_dir))


def mart_risk_exposure_merged(spark, sf_dir):
    return gold.risk_exposure(gold.rolled_up(_cube(spark, sf_dir), incremental.EXPOSURE_KEYS), CFG)


def anomaly_rate(spark, sf_dir):
    return _mart("mart_risk_exposure")(spark, sf_dir).select(
        "trader_id", "desk", "region", "anomaly_trades", "total_trades", "anomaly_rate_pct"
    )


def layer_reconciliation(spark, sf_dir):
    intake = cleaning.intake(trades_view.bronze(spark, sf_dir))
    return profile.reconciliation(intake, profile.cube_counts(_cube(spark, sf_dir), gold.GRAINS))


def bronze_quarantine(spark, sf_dir):
    checked = _checked(spark, sf_dir).withColumn(validate.LOAD, F.lit("load-1"))
    return jobs.quarantine_rows(checked, F.lit(trades_view.INGESTED_AT).cast("timestamp"))


def bronze_fresh(spark, sf_dir):
    """What a load appends to a Bronze that holds everything but the pending trades."""
    target = _trades(spark, sf_dir).where(F.col("status") != "PENDING")
    at = F.lit(trades_view.INGESTED_AT).cast("timestamp")
    return jobs.fresh_rows(_checked(spark, sf_dir), target, at)


def _parsed(spark, sf_dir):
    return landing.parse(trades_view.landing_lines(spark, sf_dir))


def landing_parse(spark, sf_dir):
    # Amounts are JSON numbers, so they are compared as numbers.
    known = ~F.col(validate.MALFORMED)
    field = lambda name: F.col(name).cast("double") if name in ("notional", "price") else F.col(name)
    return _parsed(spark, sf_dir).select(
        F.regexp_extract(validate.RAW, "T[0-9]{10}", 0).alias("line_id"),
        F.col(validate.MALFORMED).alias("malformed"),
        F.array_join(validate.NOT_TEXT, ", ").alias("not_text"),
        *[F.when(known, field(name)).alias(name) for name in validate.FIELDS],
    )


def landing_validate(spark, sf_dir):
    return validate.check(_parsed(spark, sf_dir)).select(
        F.regexp_extract(validate.RAW, "T[0-9]{10}", 0).alias("line_id"),
        F.col(validate.VALID).alias("is_valid"),
        F.array_join(validate.ERRORS, "; ").alias("error"),
    )


def landing_drift(spark, sf_dir):
    """The landing lines against the contract; a trade whose id ends in 7 names its price differently."""
    lines = trades_view.landing_lines(spark, sf_dir)
    renamed = F.regexp_replace("value", '^(.{0,20}"T[0-9]{9}7".*)"price"', '$1"px"')
    changed = lines.select(renamed.alias("value"))
    return drift.drift(drift.variants(changed))


def fx_conversion_table(spark, sf_dir):
    """The conversion with a rate table a caller brings."""
    rates = trades_view.counted_rates(_trades(spark, sf_dir))
    converted = features.convert_with(_clean(spark, sf_dir), rates)
    return converted.select("trade_id", "instrument", "notional", "notional_eur")


def table_by_sql_path(spark, sf_dir):
    return tables.read_path_sql(spark, f"{sf_dir}/customer.parquet", CFG)


def staged_view(spark, sf_dir):
    """Staged trades through their SQL view."""
    sink.as_view(_staged(spark, sf_dir), "registered_stg_trades")
    return spark.sql(
        "SELECT desk, region, count(*) AS trades, sum(notional_eur) AS eur "
        "FROM registered_stg_trades GROUP BY desk, region"
    )


def sample_size(spark, sf_dir):
    rows = profile.sample_rows(_trades(spark, sf_dir), 10, "trade_id", "notional")
    return rows.agg(F.count("trade_id").alias("n_rows"), F.count("notional").alias("n_amounts"))


def _suite(kind, *only):
    def query(spark, sf_dir):
        found = _tables(spark, sf_dir)
        chosen = {name: found[name] for name in only} if only else found
        suite = quality.run_suite(chosen, [kind], quality.SAME_ROWS)
        return suite.select("rule", "failing_rows")

    return query


QUERIES: dict[str, Query] = {
    "bronze_scan": bronze_scan,
    "bronze_validate": bronze_validate,
    "bronze_valid": lambda s, d: validate.valid(_checked(s, d)),
    "bronze_quarantine": bronze_quarantine,
    "bronze_fresh": bronze_fresh,
    "landing_parse": landing_parse,
    "landing_validate": landing_validate,
    "landing_drift": landing_drift,
    "table_by_sql_path": table_by_sql_path,
    "staged_view": staged_view,
    "sample_size": sample_size,
    "fx_conversion_table": fx_conversion_table,
    "velocity_alerts": lambda s, d: alerts.passing_trades(_clean(s, d), CFG),
    "velocity_windows": lambda s, d: velocity_counts(_clean(s, d), CFG),
    "sorted_daily_volume": _sorted("mart_daily_volume"),
    "sorted_risk_exposure": _sorted("mart_risk_exposure"),
    "sorted_top_instruments": _sorted("mart_top_instruments"),
    "bronze_summary": lambda s, d: validate.summary(_checked(s, d)),
    "bronze_merge_insert": bronze_merge_insert,
    "bronze_insert_pruned": bronze_insert_pruned,
    "silver_clean": silver_clean,
    "silver_not_cancelled": silver_not_cancelled,
    "fx_conversion": fx_conversion,
    "signed_notional": lambda s, d: _featured(s, d).select(
        "trade_id", "direction", "notional_eur", "signed_notional_eur"
    ),
    "risk_features": lambda s, d: _featured(s, d).select(
        "trade_id", "notional_eur", "is_large_trade", "risk_tier"
    ),
    "time_of_day": lambda s, d: _featured(s, d).select("trade_id", "trade_hour", "time_of_day"),
    "velocity": lambda s, d: _active(s, d).select(
        "trade_id", "trader_id", "trade_date", "trade_hour", "trades_in_hour", "velocity_flag"
    ),
    "running_notional": lambda s, d: _active(s, d).select(
        "trade_id", "trader_id", "trade_date", "notional_eur", "trader_daily_notional_run"
    ),
    "alert_level": lambda s, d: features.add_alerts(_active(s, d)).select(
        "trade_id", "is_anomaly", "velocity_flag", "alert_level"
    ),
    "silver_trades": _silver,
    "silver_zorder": silver_zorder,
    "stg_trades": _staged,
    "int_trade_enriched": _enriched,
    "calendar_features": calendar_features,
    "exposure_tier": exposure_tier,
    "cents_to_euros": cents_to_euros,
    "cents_to_euros_sql": cents_to_euros_sql,
    "fx_conversion_sql": fx_conversion_sql,
    "trades_between": trades_between,
    "mart_daily_volume": _mart("mart_daily_volume"),
    "mart_risk_exposure": _mart("mart_risk_exposure"),
    "mart_top_instruments": _mart("mart_top_instruments"),
    "mart_risk_exposure_merged": mart_risk_exposure_merged,
    "mart_top_instruments_merged": mart_top_instruments_merged,
    "distinct_by_bitmaps": distinct_by_bitmaps,
    "buy_sell_volume": buy_sell_volume,
    "conditional_counts": conditional_counts,
    "worst_alert": worst_alert,
    "distinct_counts": distinct_counts,
    "anomaly_rate": anomaly_rate,
    "alert_breakdown": lambda s, d: profile.breakdown(_silver(s, d), "alert_level"),
    "risk_breakdown": lambda s, d: profile.breakdown(_featured(s, d), "risk_tier"),
    "status_breakdown": lambda s, d: profile.breakdown(_trades(s, d), "status"),
    "rows_per_date": lambda s, d: profile.breakdown(_clean(s, d), "trade_date"),
    "silver_summary": lambda s, d: profile.silver_summary(_clean(s, d)),
    "top_velocity_traders": lambda s, d: profile.flagged_traders(_silver(s, d)),
    "top_daily_volume": lambda s, d: gold.latest_days(_mart("mart_daily_volume")(s, d)),
    "top_risk_traders": lambda s, d: gold.top_exposures(_mart("mart_risk_exposure")(s, d)),
    "instrument_ranking": lambda s, d: gold.instrument_ranking(
        _mart("mart_top_instruments")(s, d)
    ),
    "layer_reconciliation": layer_reconciliation,
    "dq_not_null": _suite("not_null"),
    "dq_accepted_values": _suite("accepted_values"),
    "dq_unique": _suite("unique"),
    "dq_positive_notional": _suite("positive", "stg_trades"),
    "dq_trade_count": _suite("positive", "mart_daily_volume"),
}


def _registered(query: Query) -> Query:
    return lambda spark, sf_dir: comparable(query(prepare(spark), sf_dir))


def queries() -> dict[str, Query]:
    return {name: _registered(query) for name, query in QUERIES.items()}
