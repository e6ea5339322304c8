"""Date and time parts of UTC instants."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Seconds since 1970 that fit a 64-bit nanosecond clock; outside them a time counts as unreadable.
EPOCH_LIMIT = 9223372036.0

# Saturday and Sunday where Sunday is 0.
WEEKEND = (0, 6)


def epoch_to_timestamp(value: Column) -> Column:
    """Epoch seconds, as number or text, to a timestamp; null when unreadable."""
    seconds = value.try_cast("double")
    return F.timestamp_seconds(F.when(F.abs(seconds) <= EPOCH_LIMIT, seconds))


def hour_bucket(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def date_key(day: Column) -> Column:
    """The date as the number YYYYMMDD."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def day_of_week_sun_0(day: Column) -> Column:
    return (F.dayofweek(day) - 1).cast("bigint")


def is_weekend(day: Column) -> Column:
    return day_of_week_sun_0(day).isin(*WEEKEND)


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def month_name(ts: Column) -> Column:
    return F.date_format(ts, "MMMM")
