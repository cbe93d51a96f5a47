"""Date windows per entity or batch of entities."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Longest window of a request, and the lookback of an incremental run.
MAX_DAYS = 90
LOOKBACK_DAYS = 10


def lookback_range(as_of: date, days: int = LOOKBACK_DAYS) -> tuple[date, date]:
    """Inclusive range of ``days`` calendar days ending at ``as_of``."""
    if days < 1:
        raise ValueError("lookback days must be >= 1")
    return as_of - timedelta(days=days - 1), as_of


def _starts(start: Column, end: Column, max_days: int) -> Column:
    return F.sequence(start, end, F.make_dt_interval(F.lit(max_days)))


def _end(window_start: Column, end: Column, max_days: int) -> Column:
    last = F.least(F.date_add(window_start, max_days - 1), end)
    return F.when(window_start.isNotNull(), last)


def slice_ranges(
    ranges: DataFrame, start: str, end: str, max_days: int = MAX_DAYS
) -> DataFrame:
    """Inclusive windows of at most ``max_days`` covering each row's range.

    An inverted range is an error.
    """
    inverted = F.raise_error(
        F.concat(F.lit("range ends "), F.col(end), F.lit(" before it starts "), F.col(start))
    )
    checked = F.when(F.col(end) < F.col(start), inverted.cast("date")).otherwise(F.col(start))
    opened = ranges.withColumn("window_start", F.explode(_starts(checked, F.col(end), max_days)))
    closed = opened.withColumn("window_end", _end(F.col("window_start"), F.col(end), max_days))
    return closed.drop(start, end)


def _span(mode: str, days: int, max_days: int) -> int:
    if mode not in ("incremental", "full"):
        raise ValueError(f"unknown mode: {mode}")
    return days if mode == "incremental" else max_days


def window_starts(
    created: Column, mode: str, as_of: date, days: int = LOOKBACK_DAYS, max_days: int = MAX_DAYS
) -> Column:
    """Array of window starts for an entity created on a day; empty when it has none yet.

    Incremental: the lookback, not before creation. Full: slices from creation to ``as_of``.
    """
    end, span = F.lit(as_of), _span(mode, days, max_days)
    if mode == "incremental":
        created = F.greatest(F.lit(lookback_range(as_of, days)[0]), created)
    none = F.array().cast("array<date>")
    return F.when(created <= end, _starts(F.least(created, end), end, span)).otherwise(none)


def window_end(
    window_start: Column,
    mode: str,
    as_of: date,
    days: int = LOOKBACK_DAYS,
    max_days: int = MAX_DAYS,
) -> Column:
    """Last day of the window with this start; null without one."""
    return _end(window_start, F.lit(as_of), _span(mode, days, max_days))


def metric_windows(
    entities: DataFrame,
    mode: str,
    as_of: date,
    days: int = LOOKBACK_DAYS,
    max_days: int = MAX_DAYS,
    keep_idle: bool = False,
) -> DataFrame:
    """One row per entity and window.

    Entities without a window have no row, or with ``keep_idle`` one row with null days.
    """
    explode = F.explode_outer if keep_idle else F.explode
    starts = explode(window_starts(F.col("created_date"), mode, as_of, days, max_days))
    opened = entities.withColumn("window_start", starts)
    end = window_end(F.col("window_start"), mode, as_of, days, max_days)
    return opened.withColumn("window_end", end)


def lookback_windows(entities: DataFrame, as_of: date, days: int = LOOKBACK_DAYS) -> DataFrame:
    """The lookback per entity, not before it was created; none if created after ``as_of``."""
    return metric_windows(entities, "incremental", as_of, days)


def backfill_windows(entities: DataFrame, as_of: date, max_days: int = MAX_DAYS) -> DataFrame:
    """Slices from creation to ``as_of`` per entity; none if created later."""
    return metric_windows(entities, "full", as_of, max_days=max_days)


def batch_windows(
    members: DataFrame,
    mode: str,
    as_of: date,
    days: int = LOOKBACK_DAYS,
    keep_idle: bool = False,
) -> DataFrame:
    """One row per batch and window shared by its members.

    Incremental runs take the plain lookback, whatever the creation dates (also for a single
    entity); full runs start at the batch's earliest creation.
    """
    batches = members.groupBy("batch").agg(
        F.min("created_date").alias("first_created"), F.count(F.lit(1)).alias("members")
    )
    earliest = F.lit(date(1970, 1, 1)) if mode == "incremental" else F.col("first_created")
    dated = batches.withColumn("created_date", earliest)
    windows = metric_windows(dated, mode, as_of, days, keep_idle=keep_idle)
    return windows.drop("created_date").withColumnRenamed("first_created", "created_date")
