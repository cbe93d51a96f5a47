"""Dates: always DATE typed, never through the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"
ISO_MONTH = r"^\d{4}-\d{2}$"


def month_of(day: Column) -> Column:
    """First day of the month as DATE."""
    return F.trunc(day, "month")


def iso_date(text: Column) -> Column:
    """YYYY-MM-DD text as DATE, null for anything else."""
    return F.when(text.rlike(ISO_DAY), text.try_cast("date"))


def statement_month(text: Column) -> Column:
    """YYYY-MM text as the first day of that month, null for anything else."""
    return F.when(text.rlike(ISO_MONTH), F.concat(text, F.lit("-01")).try_cast("date"))


def own_offset_date(text: Column) -> Column:
    """Calendar day of an ISO timestamp in the offset it was written with."""
    return iso_date(F.substring(text, 1, 10))


def period_number(day: Column, grain: str) -> Column:
    """Partition value of a day: 202607 for months, 20260731 for days."""
    number = F.year(day) * 100 + F.month(day)
    if grain == "day":
        number = number * 100 + F.dayofmonth(day)
    return number.cast("int")
