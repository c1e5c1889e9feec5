"""Calendar and clock expressions; sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelftrack import fixed_values as fixed
from shelftrack.functions.text import as_column


def to_local(ts: Column | str, zone: str = fixed.LOCAL_ZONE) -> Column:
    """Shift a UTC instant to the wall clock of ``zone``, daylight saving included."""
    return F.from_utc_timestamp(as_column(ts), zone)


def local_day(ts: Column | str, zone: str = fixed.LOCAL_ZONE) -> Column:
    return F.to_date(to_local(ts, zone))


def date_id(day: Column | str) -> Column:
    """Day as a ``yyyyMMdd`` number."""
    day = as_column(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_start(day: Column | str, months: int = 0) -> Column:
    """First day of the month ``months`` away."""
    return F.trunc(F.add_months(as_column(day), months), "MM")


def calendar_columns(day: Column | str) -> list[Column]:
    """The attributes of a date dimension row."""
    day = as_column(day)
    iso_day = F.weekday(day) + 1
    return [
        date_id(day).alias("date_id"),
        day.alias("full_date"),
        F.dayofmonth(day).alias("day_of_month"),
        F.month(day).alias("month_of_year"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter_of_year"),
        F.date_format(day, "EEEE").alias("day_name"),
        iso_day.alias("day_of_week_iso"),
        iso_day.isin(6, 7).alias("is_weekend"),
    ]


def seconds_between(start: Column | str, finish: Column | str) -> Column:
    """Elapsed seconds with their fraction; text that is no timestamp gives NULL."""
    begin, end = (F.unix_micros(as_column(c).try_cast("timestamp")) for c in (start, finish))
    return (end - begin) / F.lit(1e6)
