"""Cohort retention: who came back on which day, wide and long."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ratio, round_half_away
from tidemark.operators.spread import counted, spread_join
from tidemark.schemas import RETENTION_DAYS

USER, DAY = "user_id", "day"
# Days that fit a number with a bit for each.
MASK_BITS = 63


def cohort_retention(
    events: DataFrame, as_of: date, *keys: str, days: int = RETENTION_DAYS
) -> DataFrame:
    """Per cohort day the users, their first returns, share returned so far and streams.

    ``events`` has (user_id, day, joins, streams). A user belongs to the day of the first joining
    event. ``returned_on_day_N`` counts users whose first return is day N, so
    ``retention_by_day_N`` (returns up to N over the cohort) never exceeds one. All three are null
    until day N has passed at ``as_of``.

    Joining events alone give each user's day; that counted lookup is met by the events where they
    are read, which leaves those of the days asked for. A user is then one number with a bit per
    active day, so events of one user add up before they move and nothing is sorted by user.
    """
    if days >= MASK_BITS:
        raise ValueError(f"at most {MASK_BITS - 1} days")
    on = (*keys, USER)
    joined = events.where("joins").groupBy(*on).agg(F.min(DAY).alias("cohort_date"))
    placed = spread_join(events.select(*on, DAY, "streams"), counted(joined), on, spread_by=(DAY, "streams"))
    numbers = range(1, days + 1)
    since = F.date_diff(F.col(DAY), F.col("cohort_date"))
    near = placed.withColumn("_n", since).where(F.col("_n").between(0, days))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_n"))
    on_day = {n: F.when(F.col("_n") == n, F.col("streams")).otherwise(0) for n in numbers}
    per_user = near.groupBy(*on, "cohort_date").agg(
        F.bit_or(bit).alias("_active"), *[F.sum(on_day[n]).alias(f"_streams_{n}") for n in numbers]
    )

    def first_on(n: int) -> Column:
        """Of the days up to n, without the first, only day n is active."""
        return F.col("_active").bitwiseAND(F.lit((1 << n + 1) - 2)) == F.lit(1 << n)

    cohorts = per_user.groupBy(*keys, "cohort_date").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        *[F.count_if(first_on(n)).alias(f"_returned_{n}") for n in numbers],
        *[F.sum(f"_streams_{n}").alias(f"_streams_{n}") for n in numbers],
    )
    columns = []
    returned = F.lit(0)
    for n in numbers:
        passed = F.date_add("cohort_date", n) < F.lit(as_of)
        returned = returned + F.col(f"_returned_{n}")
        share = round_half_away(ratio(returned, F.col("cohort_size")), 4)
        columns += [
            F.when(passed, F.col(f"_returned_{n}")).alias(f"returned_on_day_{n}"),
            F.when(passed, share).alias(f"retention_by_day_{n}"),
            F.when(passed, F.col(f"_streams_{n}")).alias(f"streams_on_day_{n}"),
        ]
    return cohorts.select(*keys, "cohort_date", "cohort_size", *columns)


def retention_long(wide: DataFrame, *keys: str, days: int = RETENTION_DAYS) -> DataFrame:
    """One row per cohort and day number from the wide form; days not yet passed stay null."""
    by_day = F.array(
        *[
            F.struct(
                F.lit(n).alias("day_number"),
                F.col(f"returned_on_day_{n}").alias("returned"),
                F.col(f"retention_by_day_{n}").alias("retention"),
                F.col(f"streams_on_day_{n}").alias("streams"),
            )
            for n in range(1, days + 1)
        ]
    )
    return wide.select(*keys, "cohort_size", F.inline(by_day))
