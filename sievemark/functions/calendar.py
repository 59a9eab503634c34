"""Date and time column helpers that do not depend on the session time zone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_LABELS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def minute_boundaries(start: Column, end: Column) -> Column:
    """Number of minute marks passed between two timestamps (00:00:59 to 00:01:01 is 1)."""
    days = F.date_diff(F.to_date(end), F.to_date(start)).cast("bigint")
    hours = days * 24 + F.hour(end) - F.hour(start)
    return hours * 60 + F.minute(end) - F.minute(start)


def same_day(start: Column, end: Column) -> Column:
    return F.to_date(start) == F.to_date(end)


def day_type(day: Column) -> Column:
    """'weekend' for Saturday and Sunday, else 'weekday'."""
    return F.when(F.dayofweek(day).isin(1, 7), "weekend").otherwise("weekday")


def days_in_year(year: int) -> int:
    return (date(year + 1, 1, 1) - date(year, 1, 1)).days


def year_start(year: int, type_name: str) -> Column:
    """January 1 as a literal of the given type, so that scans can push the comparison down."""
    return F.lit(f"{year:04d}-01-01").cast(type_name)


def month_label(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(label) for label in MONTH_LABELS]), month)
