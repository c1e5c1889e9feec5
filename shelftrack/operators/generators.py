"""Row generators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_day(value: date | str | Column | None) -> Column:
    """A day given as text, date or column; the run date when left out."""
    if value is None:
        return F.current_date()
    return value.cast("date") if isinstance(value, Column) else F.lit(str(value)).cast("date")


def date_spine(
    spark: SparkSession, start: date | str | Column, end: date | str | Column, name: str = "full_date"
) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(as_day(start), as_day(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias(name))
