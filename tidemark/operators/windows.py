"""Spend windows of campaigns, and facts restricted to them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import money, month_of, period_number
from tidemark.operators.spread import counted, spread_join

CAMPAIGN = "campaign_id"
# Column of a stored table read with its periods.
PERIOD = "period"


def spend_profile(country_daily: DataFrame, by: str = CAMPAIGN) -> DataFrame:
    """First and last day with spend and the spend of all days, in one pass over the facts."""
    spend_day = F.when(F.col("spend_total") > 0, F.col("report_date"))
    return country_daily.groupBy(by).agg(
        F.min(spend_day).alias("first_day"),
        F.max(spend_day).alias("last_day"),
        F.sum(money(F.col("spend_total"))).alias("spend_usd"),
    )


def spend_window(country_daily: DataFrame, by: str = CAMPAIGN) -> DataFrame:
    """Campaigns that spent, with their first and last spend day."""
    spent = country_daily.where(F.col("spend_total") > 0)
    return spent.groupBy(by).agg(
        F.min("report_date").alias("first_day"), F.max("report_date").alias("last_day")
    )


def spend_months(windows: DataFrame, by: str = CAMPAIGN) -> DataFrame:
    """First and last spend month of each window."""
    return windows.select(
        by,
        month_of(F.col("first_day")).alias("first_month"),
        month_of(F.col("last_day")).alias("last_month"),
    )


def total_spend(country_daily: DataFrame, by: str = CAMPAIGN) -> DataFrame:
    """Spend of all days, inside the window or not."""
    return country_daily.groupBy(by).agg(F.sum(money(F.col("spend_total"))).alias("spend_usd"))


def date_spine(windows: DataFrame, countries: Sequence[str], by: str = CAMPAIGN) -> DataFrame:
    """One row per day of each window and country, for reports that must not skip days."""
    days = windows.select(by, F.explode(F.sequence("first_day", "last_day")).alias("report_date"))
    every = F.explode(F.array(*[F.lit(country) for country in countries]))
    return days.withColumn("country_code", every)


def within_window(
    rows: DataFrame, windows: DataFrame, spread_by: Sequence[str], by: str = CAMPAIGN
) -> DataFrame:
    """Rows whose day lies in their campaign's window, with the window's columns.

    An equi-join on the campaign with the range as a filter: few windows are broadcast, many are
    shuffled with the rows. Rows and columns are the same either way.
    """
    lookup = counted(windows)
    return _between(spread_join(within_periods(rows, lookup.rows), lookup, by, spread_by))


def sums_within_window(
    rows: DataFrame,
    windows: DataFrame,
    daily: Callable[[DataFrame], DataFrame],
    spread_by: Sequence[str],
    by: str = CAMPAIGN,
) -> DataFrame:
    """``within_window`` for callers that go on to sum by day or coarser.

    Few windows are broadcast and filter the rows where they are read. Otherwise ``daily`` sums
    the rows to days before they are shuffled. What is handed on is therefore rows or daily sums,
    with the columns of ``daily`` and the window's; a sum over either is the same.
    """
    lookup = counted(windows)
    rows = within_periods(rows, lookup.rows)
    if not lookup.small:
        return _between(spread_join(daily(rows), lookup, by, spread_by))
    names = [*daily(rows).columns, *[c for c in lookup.rows.columns if c != by]]
    return _between(spread_join(rows, lookup, by, spread_by)).select(*names)


def within_periods(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows of a stored table read with its periods, without the periods no window touches.

    The months of all windows are found when the query runs and the scan opens their folders
    only. A calendar has few months, so they are always broadcast. Rows without ``period`` stay
    as they are.
    """
    if PERIOD not in rows.columns:
        return rows
    first, last = (F.trunc(name, "month") for name in ("first_day", "last_day"))
    months = windows.where(F.col("first_day") <= F.col("last_day")).select(
        F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("_month")
    )
    number = period_number(F.col("_month"), "month").alias("_touched")
    # Days are numbered within their month.
    month = F.when(F.col(PERIOD) > 999999, F.floor(F.col(PERIOD) / 100)).otherwise(F.col(PERIOD)).cast("int")
    touched = F.broadcast(months.select(number).distinct())
    return rows.join(touched, month == F.col("_touched"), "left_semi")


def _between(joined: DataFrame) -> DataFrame:
    return joined.where(F.col("report_date").between(F.col("first_day"), F.col("last_day")))
