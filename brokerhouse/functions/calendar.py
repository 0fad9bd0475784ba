"""Business dates and their parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def date_parts(day: Column) -> list[Column]:
    """Columns of the date dimension, for a date column."""
    return [
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day.alias("business_date"),
        F.year(day).alias("year_number"),
        F.month(day).alias("month_number"),
        F.day(day).alias("day_number"),
        F.date_format(day, "EEEE").alias("weekday_name"),
    ]


def run_date(utc_timestamp: Column, zone: str = "UTC") -> Column:
    """Business date of a UTC wall-clock time, seen from `zone`."""
    if zone == "UTC":
        return F.to_date(utc_timestamp)
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_timestamp))


def next_calendar_day(day: Column) -> Column:
    return F.date_add(day, 1)


def plus_seconds(moment: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, moment)
