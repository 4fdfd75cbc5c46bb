"""Time-of-day buckets and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A bucket holds the hours below its bound that no earlier bucket holds.
DAY_PARTS = ((8, "PREMARKET"), (12, "MORNING"), (16, "AFTERNOON"), (18, "CLOSE"))
AFTER_CLOSE = "AFTERHOURS"

# Market hours, both ends included (07:00 up to 17:59 UTC).
MARKET_OPEN_HOUR = 7
MARKET_LAST_HOUR = 17

# Spark's day numbers of Sunday and Saturday.
WEEKEND = (1, 7)


def time_of_day(hour: Column) -> Column:
    """The bucket of an hour; an unknown hour counts as after hours."""
    bound, name = DAY_PARTS[0]
    bucket = F.when(hour < bound, name)
    for bound, name in DAY_PARTS[1:]:
        bucket = bucket.when(hour < bound, name)
    return bucket.otherwise(AFTER_CLOSE)


def is_market_hours(hour: Column) -> Column:
    return F.coalesce(hour.between(MARKET_OPEN_HOUR, MARKET_LAST_HOUR), F.lit(False))


def day_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def is_weekend(date: Column) -> Column:
    return F.coalesce(F.dayofweek(date).isin(*WEEKEND), F.lit(False))
