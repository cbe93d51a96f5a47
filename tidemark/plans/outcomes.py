"""How a run ended: failures, completed entities, statistics and control rows.

A result row is one request: run_key, batch, entity_id (null for batch requests), window_start,
kind, ok, status, message, body, rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.windows import LOOKBACK_DAYS, window_starts

# Text a provider answers with when a metric is not part of the plan. Fixed value.
PLAN_CODE = "premium_plan_required"

HARD, SOFT, SKIP = "hard", "soft", "skip"


def run_key(entity: str, mode: str, day: date) -> str:
    """Name of a run: entity family (none for campaigns), mode and calendar day."""
    family = [] if entity == "campaigns" else [entity]
    return ":".join(["run", *family, mode, day.isoformat()])


def last_sync_key(entity: str) -> str:
    return "last_sync" if entity == "campaigns" else f"last_sync_{entity}"


def plan_refused(status: Column, message: Column, body: Column) -> Column:
    """True for a 403 whose message or body names the plan code, in any case."""
    text = F.lower(F.concat_ws(" ", message, body))
    return F.coalesce((status == 403) & text.contains(PLAN_CODE), F.lit(False))


def classify_errors(results: DataFrame) -> DataFrame:
    """Adds ``severity`` to failed requests: retention never fails a run, all else does."""
    refused = plan_refused(F.col("status"), F.col("message"), F.col("body"))
    severity = (
        F.when(F.col("ok"), F.lit(None))
        .when(F.col("kind") != "retention", HARD)
        .when(refused, SKIP)
        .otherwise(SOFT)
    )
    return results.withColumn("severity", severity)


def campaign_outcome(results: DataFrame, *keys: str) -> DataFrame:
    """A campaign is complete when none of its windows failed."""
    judged = classify_errors(results)
    return judged.groupBy(*keys, "entity_id").agg(
        F.count_if(F.col("severity") == HARD).alias("hard_errors"),
        F.bool_and(F.coalesce(F.col("severity") != HARD, F.lit(True))).alias("completed"),
    )


def link_outcome(members: DataFrame, results: DataFrame, *keys: str) -> DataFrame:
    """Completed links under the batch rules.

    A failed breakdown fails every member of the batch and leaves out the window's retention
    and engagement; members failed once get no further engagement requests, so later engagement
    failures do not exist for them. Retention never fails a link. ``members`` has
    (keys, batch, entity_id).
    """
    failed = results.where(~F.col("ok"))
    batch_keys = [*keys, "batch"]
    batches = failed.where(F.col("kind") == "breakdown").groupBy(*batch_keys).agg(
        F.min("window_start").alias("batch_failed_at"),
        F.count_distinct("window_start").alias("failed_windows"),
    )
    single = failed.where(F.col("kind") == "engagement")
    first = single.groupBy(*batch_keys, "entity_id").agg(F.min("window_start").alias("failed_at"))
    judged = members.join(batches, batch_keys, "left").join(
        first, [*batch_keys, "entity_id"], "left"
    )
    own_failure = F.col("failed_at").isNotNull() & (
        F.col("batch_failed_at").isNull() | (F.col("failed_at") < F.col("batch_failed_at"))
    )
    return judged.select(
        *batch_keys,
        "entity_id",
        F.col("batch_failed_at").isNotNull().alias("batch_failed"),
        own_failure.alias("engagement_failed"),
        (F.col("batch_failed_at").isNull() & ~own_failure).alias("completed"),
    )


def progress_rows(outcome: DataFrame, completed_before: DataFrame, *keys: str) -> DataFrame:
    """Ids to remember as completed, those done before and those done now, in id order.

    One row per id: a list per run would put all ids of a run into one value.
    """
    done = outcome.where("completed").select(*keys, "entity_id")
    both = completed_before.select(*keys, "entity_id").unionByName(done).distinct()
    return both.orderBy(*keys, "entity_id")


def run_stats(results: DataFrame, *keys: str) -> DataFrame:
    """Rows loaded per kind, windows and errors by severity of each run."""
    judged = classify_errors(results)
    rows = {
        f"{kind}_rows": F.coalesce(
            F.sum(F.when(F.col("ok") & (F.col("kind") == kind), F.col("rows"))), F.lit(0)
        )
        for kind in ("breakdown", "engagement", "retention")
    }
    per_window = judged.groupBy(*keys, "batch", "window_start").agg(
        *[total.alias(name) for name, total in rows.items()],
        *[
            F.count_if(F.col("severity") == severity).alias(f"{severity}_errors")
            for severity in (HARD, SOFT, SKIP)
        ],
    )
    names = [*rows, *[f"{severity}_errors" for severity in (HARD, SOFT, SKIP)]]
    return per_window.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("windows_processed"),
        *[F.sum(name).alias(name) for name in names],
    )


def no_window(mode: str, as_of: date, days: int = LOOKBACK_DAYS, in_batches: bool = False) -> Column:
    """Whether an entity with this ``created_date`` asks for no window of its own.

    The windows of a batch are shared: an incremental run asks for the plain lookback of every
    batch, and a full run from the earliest creation in it, so a member without a window of its
    own is idle only if its whole batch is, that is if nothing was requested for it.
    """
    if in_batches and mode == "incremental":
        return F.lit(False)
    return F.size(window_starts(F.col("created_date"), mode, as_of, days)) == 0


def entity_stats(
    entities: DataFrame,
    completed_before: DataFrame,
    mode: str,
    as_of: date,
    days: int = LOOKBACK_DAYS,
    by: str = "entity_id",
    requested: DataFrame | None = None,
    in_batches: bool = False,
) -> DataFrame:
    """One row: entities listed, resumed (done before) and skipped (no window yet).

    ``requested`` lists entities that had a request after all. ``in_batches`` marks families whose
    windows belong to a batch: its incremental runs skip nobody.
    """
    done = completed_before.select(by).distinct().withColumn("_done", F.lit(True))
    asked = (done.limit(0) if requested is None else requested.select(by).distinct()).select(
        by, F.lit(True).alias("_asked")
    )
    marked = entities.select(by, "created_date").join(done, by, "left").join(asked, by, "left")
    resumed = F.col("_done").isNotNull()
    idle = no_window(mode, as_of, days, in_batches) & F.col("_asked").isNull()
    return marked.agg(
        F.count(F.lit(1)).alias("entities_synced"),
        F.count_if(resumed).alias("entities_resumed"),
        F.count_if(~resumed & idle).alias("entities_skipped"),
    )


def finished_runs(stats: DataFrame) -> DataFrame:
    """Runs without hard errors: only these get a last-sync record and lose their progress."""
    return stats.where(F.col("hard_errors") == 0)


def unfinished_progress(progress: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Progress rows to keep, with the run's error count."""
    errors = stats.where(F.col("hard_errors") > 0).select(
        *keys, F.col("hard_errors").alias("error_count")
    )
    return progress.join(errors, list(keys))
