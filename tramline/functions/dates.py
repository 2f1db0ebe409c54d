"""Dates and times of schedules, as column expressions."""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTES_PER_DAY = 1440
MINUTES_PER_WEEK = 7 * MINUTES_PER_DAY
LAST_DATE = 20991231


def parse_date(x: Column, default: Column | None = None) -> Column:
    """YYYYMMDD (string or number) to a date. Null, and numbers after 2099-12-31, give ``default``; other unreadable values give null."""
    default = F.lit(None).cast("date") if default is None else default
    s = F.trim(x.cast("string"))
    read = F.when(s.rlike(r"^\d{8}$"), F.try_to_timestamp(s, F.lit("yyyyMMdd")).cast("date"))
    return F.when(s.isNull() | (s == "") | (s.try_cast("bigint") > LAST_DATE), default).otherwise(read)


def parse_time(s: Column) -> Column:
    """HH:MM:SS to seconds since midnight; hours may exceed 24; anything but three numbers gives null."""
    read = lambda parts: F.when(F.size(parts) == 3, F.aggregate(parts, F.lit(0), lambda total, x: total * 60 + F.trim(x).try_cast("int")))
    return F.get(F.transform(F.array(F.split(F.trim(s.cast("string")), ":")), read), F.lit(0))  # split once


def time_to_minutes_from_midnight(s: Column) -> Column:
    return F.floor(parse_time(s) / 60).cast("int")


def stop_minute(arrival: Column, departure: Column) -> Column:
    """Whole minute between arrival and departure; null if either can't be read."""
    return F.floor((time_to_minutes_from_midnight(arrival) + time_to_minutes_from_midnight(departure)) / 2).cast("int")


def minutes_from_week_start(day_of_week: Column, minute: Column) -> Column:
    """Monday is 0."""
    return day_of_week * MINUTES_PER_DAY + minute


def valid_timezone(tz: Column) -> Column:
    """The zone, or UTC where it is blank or unknown."""
    return F.when(F.trim(tz).isin(sorted(zoneinfo.available_timezones())), F.trim(tz)).otherwise("UTC")


def local_minutes_to_week_minutes_utc(date: Column, minute: Column, tz: Column) -> Column:
    """Minute of the UTC week of a local wall-clock minute."""
    wall = F.timestamp_seconds(F.unix_date(date).cast("long") * 86400 + minute.cast("long") * 60)
    at = F.unix_timestamp(F.to_utc_timestamp(wall, valid_timezone(tz)))
    return F.pmod(F.floor(at / 60) + 3 * MINUTES_PER_DAY, F.lit(MINUTES_PER_WEEK)).cast("int")  # 1970-01-01 was a Thursday


def segment_minutes(start: Column, end: Column) -> Column:
    """Duration between two stops of a journey, wrapped at midnight."""
    return F.pmod(end - start, F.lit(MINUTES_PER_DAY))


def index_from_start(n: Column, i: Column, offset: Column) -> Column:
    """i + offset, stepped back by the whole weeks in n until it is below n."""
    at, period = i + offset, F.floor(n / 7) * 7
    return (at - period * F.greatest(F.lit(0), F.floor((at - n + period) / period))).cast("int")
