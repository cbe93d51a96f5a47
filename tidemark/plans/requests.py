"""Batches of ids and the list of requests a fetcher has to make."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.windows import LOOKBACK_DAYS, batch_windows, metric_windows
from tidemark.session import pinned

# Fixed value: most ids in one request.
BATCH_SIZE = 50
PLANNED, SKIPPED = "planned", "skipped"


def pending_entities(entities: DataFrame, completed: DataFrame, by: str) -> DataFrame:
    """Entities not yet completed in this run."""
    return entities.join(completed.select(by), by, "left_anti")


def numbered(rows: DataFrame, *order: str | Column, ranges: int | None = None) -> DataFrame:
    """Adds ``position``, the 0-based place in a total order, without one global sort task.

    Rows are spread by ranges of the order and stored, each range is numbered on its own, and
    the sizes of the lower ranges are added. There are as many ranges as the session has shuffle
    partitions, so the list of sizes depends on the cluster and not on the data.
    """
    ranges = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id())
    stored = pinned(ranged, "ranged")
    sizes = stored.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    below = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_range", F.coalesce(F.sum("_rows").over(below), F.lit(0)).alias("_offset")
    )
    in_range = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    placed = stored.withColumn("_place", in_range).join(F.broadcast(offsets), "_range")
    position = (F.col("_offset") + F.col("_place")).cast("bigint")
    return placed.withColumn("position", position).select(*rows.columns, "position")


def id_batches(rows: DataFrame, *order: str | Column, size: int = BATCH_SIZE) -> DataFrame:
    """Adds ``batch``: consecutive groups of at most ``size`` rows in the given order."""
    batch = F.floor(F.col("position") / size).cast("bigint")
    return numbered(rows, *order).withColumn("batch", batch).drop("position")


def _requests(windows: DataFrame, kinds: list[str], *names: str) -> DataFrame:
    """A request per window and kind, or one skipped row where there is no window."""
    idle = F.col("window_start").isNull()
    none = F.array(F.lit(None).cast("string"))
    each = F.explode(F.when(idle, none).otherwise(F.array(*[F.lit(kind) for kind in kinds])))
    status = F.when(idle, SKIPPED).otherwise(PLANNED)
    return windows.select(
        *names, "window_start", "window_end", each.alias("kind"), status.alias("status")
    )


def plan_campaign_requests(
    campaigns: DataFrame,
    mode: str,
    as_of: date,
    days: int = LOOKBACK_DAYS,
    by: str = "campaign_id",
) -> DataFrame:
    """Breakdown and engagement per campaign and window; skipped campaigns count as complete.

    One pass over the entities: a campaign without a window keeps one row that says so.
    """
    dated = campaigns.select(by, "created_date")
    windows = metric_windows(dated, mode, as_of, days, keep_idle=True)
    return _requests(windows, ["breakdown", "engagement"], by)


def plan_link_requests(
    members: DataFrame, mode: str, as_of: date, days: int = LOOKBACK_DAYS, by: str = "link_id"
) -> DataFrame:
    """Breakdown and retention per batch and window, engagement per member and window.

    ``members`` has (``by``, created_date, batch). Batch requests have a null member.
    """
    windows = batch_windows(members, mode, as_of, days, keep_idle=True)
    shared = _requests(windows, ["breakdown", "retention"], "batch")
    shared = shared.withColumn(by, F.lit(None).cast(members.schema[by].dataType))
    ranges = windows.where(F.col("window_start").isNotNull())
    single = members.select(by, "batch").join(
        ranges.select("batch", "window_start", "window_end"), "batch"
    )
    single = single.withColumns({"kind": F.lit("engagement"), "status": F.lit(PLANNED)})
    return shared.unionByName(single)
