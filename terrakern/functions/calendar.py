"""Solar days, windows and date ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def solar_offset_hours(longitude: Column) -> Column:
    """Whole hours of longitude / 15, cut towards zero."""
    return F.when(longitude >= 0, F.floor(longitude / 15)).otherwise(F.ceil(longitude / 15)).cast("int")


def solar_day(instant: Column, longitude: Column) -> Column:
    """The local solar date of a UTC instant."""
    return F.to_date(F.timestamp_seconds(F.unix_seconds(instant.cast("timestamp")) + solar_offset_hours(longitude) * 3600))


def noon(day: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds(day.cast("timestamp")) + 43200)


def middle_longitude(west: Column, east: Column) -> Column:
    """Middle of a box; a box with west > east crosses the antimeridian and is walked eastward."""
    middle = F.when(west > east, west + (east + 360 - west) / 2).otherwise((west + east) / 2)
    return F.when(middle > 180, middle - 360).otherwise(middle)


def month_window(start: Column, months: int = 12) -> tuple[Column, Column]:
    """First day of the month and first day ``months`` later."""
    first = F.trunc(start, "month")
    return first, F.add_months(first, months)


def in_window(day: Column, start: Column, months: int = 12) -> Column:
    first, after = month_window(start, months)
    return (day >= first) & (day < after)


def fixed_ranges(start: Column, end: Column, days: int) -> Column:
    """Consecutive ranges of ``days`` days that partition start..end: array of struct(first, last)."""
    steps = F.sequence(F.lit(0), F.floor(F.datediff(end, start) / days).cast("int"))
    return F.transform(steps, lambda k: F.struct(F.date_add(start, k * days).alias("first"), F.least(end, F.date_add(start, k * days + (days - 1))).alias("last")))


def resume_start(requested: Column, newest: Column) -> Column:
    """Never before the request, and after the newest stored day."""
    return F.greatest(requested, F.date_add(newest, 1))


def aware_instant(text: Column) -> Column:
    """An ISO instant with a zone; null without one."""
    return F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), F.try_to_timestamp(text))
