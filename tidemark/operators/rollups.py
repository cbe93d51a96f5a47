"""Ad-hoc questions over the stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import money


def latest_rows(
    facts: DataFrame, key: Sequence[str], columns: Sequence[str], k: int = 10
) -> DataFrame:
    """The k newest rows; the key makes equal days a fixed order.

    Each task keeps k rows, so nothing is sorted as a whole.
    """
    rest = [F.col(name).asc_nulls_last() for name in key if name != "report_date"]
    ordered = facts.orderBy(F.col("report_date").desc_nulls_last(), *rest)
    return ordered.select(*columns).limit(k)


def trailing_rollup(
    facts: DataFrame,
    entities: DataFrame,
    by: str,
    measures: dict[str, str],
    as_of: date,
    days: int = 30,
) -> DataFrame:
    """Sums per entity and status over the trailing days, largest first measure first.

    ``measures`` maps result names to fact columns. Facts are summed before the entities are
    joined, so the join sees one row per entity.
    """
    recent = facts.where(F.col("report_date") >= F.date_sub(F.lit(as_of), days))
    sums = [_total(facts, column).alias(name) for name, column in measures.items()]
    totals = recent.groupBy(by).agg(*sums)
    named = entities.select(by, "status").join(totals, by)
    first = next(iter(measures))
    return named.orderBy(F.desc_nulls_last(first), by)


def _total(facts: DataFrame, column: str):
    amount = F.col(column)
    if facts.schema[column].dataType.typeName() in ("double", "decimal"):
        return F.sum(money(amount)).cast("double")
    return F.sum(amount)
