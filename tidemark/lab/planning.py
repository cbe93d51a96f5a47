"""Registered queries: windows, batches, request plans and run outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.lab import sql, views
from tidemark.plans import outcomes, requests, windows

RUN = ("run_day", "run_slot")
_ENTITIES = sql.with_views(sql.ENTITIES)
_RESULTS = sql.with_views(sql.RESULTS)


def lookback_windows(spark: SparkSession, sf: str) -> DataFrame:
    return windows.lookback_windows(views.entities(spark, sf), views.AS_OF)


LOOKBACK_WINDOWS = f"""{_ENTITIES}
SELECT entity_id, created_date, greatest(created_date, DATE '2001-07-18') AS window_start,
  DATE '2001-07-27' AS window_end
FROM entities WHERE created_date <= DATE '2001-07-27'"""


def backfill_windows(spark: SparkSession, sf: str) -> DataFrame:
    slices = windows.backfill_windows(views.entities(spark, sf), views.AS_OF)
    length = F.date_diff("window_end", "window_start") + 1
    return slices.groupBy("created_date").agg(
        F.count(F.lit(1)).alias("n_windows"),
        F.count_distinct("entity_id").alias("entities"),
        F.sum(length.cast("bigint")).alias("days"),
        F.max(length).alias("longest"),
        F.max("window_end").alias("last_day"),
    )


BACKFILL_WINDOWS = f"""{_ENTITIES}
SELECT created_date,
  CAST(SUM((DATE '2001-07-27' - created_date) // 90 + 1) AS BIGINT) AS n_windows,
  COUNT(*) AS entities, CAST(SUM(DATE '2001-07-27' - created_date + 1) AS BIGINT) AS days,
  CAST(MAX(least(90, DATE '2001-07-27' - created_date + 1)) AS INTEGER) AS longest,
  DATE '2001-07-27' AS last_day
FROM entities WHERE created_date <= DATE '2001-07-27' GROUP BY created_date"""


def _members(spark: SparkSession, sf: str) -> DataFrame:
    return requests.id_batches(views.entities(spark, sf), "created_date", "entity_id")


def id_batches(spark: SparkSession, sf: str) -> DataFrame:
    return _members(spark, sf).groupBy("batch").agg(
        F.count(F.lit(1)).alias("members"),
        F.min("created_date").alias("first_created"),
        F.max("created_date").alias("last_created"),
        F.min("entity_id").alias("smallest_id"),
    )


_BATCHED = f"""{_ENTITIES},
members AS (
  SELECT *, CAST(floor((row_number() OVER (ORDER BY created_date, entity_id) - 1) / 50) AS BIGINT)
    AS batch
  FROM entities
)"""

ID_BATCHES = f"""{_BATCHED}
SELECT batch, COUNT(*) AS members, MIN(created_date) AS first_created,
  MAX(created_date) AS last_created, MIN(entity_id) AS smallest_id
FROM members GROUP BY batch"""


def batch_windows(spark: SparkSession, sf: str) -> DataFrame:
    return windows.batch_windows(_members(spark, sf), "full", views.AS_OF)


BATCH_WINDOWS = f"""{_BATCHED},
batches AS (
  SELECT batch, MIN(created_date) AS created_date, COUNT(*) AS members FROM members GROUP BY batch
),
starts AS (
  SELECT *, CAST(unnest(generate_series(created_date, DATE '2001-07-27', INTERVAL 90 DAY)) AS DATE)
    AS window_start
  FROM batches WHERE created_date <= DATE '2001-07-27'
)
SELECT *, least(window_start + 89, DATE '2001-07-27') AS window_end FROM starts"""


def plan_requests(spark: SparkSession, sf: str) -> DataFrame:
    return requests.plan_campaign_requests(
        views.entities(spark, sf), "incremental", views.AS_OF, by="entity_id"
    )


PLAN_REQUESTS = f"""{_ENTITIES}
SELECT entity_id, greatest(created_date, DATE '2001-07-18') AS window_start,
  DATE '2001-07-27' AS window_end, kind, 'planned' AS status
FROM entities, (VALUES ('breakdown'), ('engagement')) k(kind)
WHERE created_date <= DATE '2001-07-27'
UNION ALL
SELECT entity_id, NULL, NULL, NULL, 'skipped' FROM entities WHERE created_date > DATE '2001-07-27'"""


def plan_batch_requests(spark: SparkSession, sf: str) -> DataFrame:
    return requests.plan_link_requests(
        _members(spark, sf), "incremental", views.AS_OF, by="entity_id"
    )


PLAN_BATCH_REQUESTS = f"""{_BATCHED}
SELECT batch, CAST(NULL AS BIGINT) AS entity_id, DATE '2001-07-18' AS window_start,
  DATE '2001-07-27' AS window_end, kind, 'planned' AS status
FROM (SELECT DISTINCT batch FROM members), (VALUES ('breakdown'), ('retention')) k(kind)
UNION ALL
SELECT batch, entity_id, DATE '2001-07-18', DATE '2001-07-27', 'engagement', 'planned'
FROM members"""


def resume_anti(spark: SparkSession, sf: str) -> DataFrame:
    orders = views.table(spark, sf, "orders")
    done = orders.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("entity_id")
    )
    return requests.pending_entities(views.entities(spark, sf), done, "entity_id")


RESUME_ANTI = f"""{_ENTITIES}
SELECT * FROM entities
WHERE entity_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')"""


def error_classify(spark: SparkSession, sf: str) -> DataFrame:
    judged = outcomes.classify_errors(views.results(spark, sf))
    return judged.groupBy("kind", "status", "severity").agg(F.count(F.lit(1)).alias("requests"))


ERROR_CLASSIFY = f"""{_RESULTS}
SELECT kind, status, severity, COUNT(*) AS requests FROM results GROUP BY ALL"""


def campaign_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return outcomes.campaign_outcome(views.results(spark, sf), *RUN)


CAMPAIGN_OUTCOME = f"""{_RESULTS}
SELECT run_day, run_slot, entity_id, COUNT(*) FILTER (severity = 'hard') AS hard_errors,
  COUNT(*) FILTER (severity = 'hard') = 0 AS completed
FROM results GROUP BY ALL"""


def run_outcome(spark: SparkSession, sf: str) -> DataFrame:
    results = views.results(spark, sf)
    members = results.select(*RUN, "batch", "entity_id").distinct()
    return outcomes.link_outcome(members, results, *RUN)


RUN_OUTCOME = f"""{_RESULTS},
broken AS (
  SELECT run_day, run_slot, batch, MIN(window_start) AS at FROM results
  WHERE kind = 'breakdown' AND NOT ok GROUP BY ALL
),
lost AS (
  SELECT DISTINCT r.run_day, r.run_slot, r.batch, r.entity_id
  FROM results r LEFT JOIN broken b USING (run_day, run_slot, batch)
  WHERE kind = 'engagement' AND NOT ok AND (b.at IS NULL OR r.window_start < b.at)
)
SELECT m.run_day, m.run_slot, m.batch, m.entity_id, b.at IS NOT NULL AS batch_failed,
  l.entity_id IS NOT NULL AS engagement_failed,
  b.at IS NULL AND l.entity_id IS NULL AS completed
FROM (SELECT DISTINCT run_day, run_slot, batch, entity_id FROM results) m
LEFT JOIN broken b USING (run_day, run_slot, batch)
LEFT JOIN lost l ON l.run_day = m.run_day AND l.run_slot = m.run_slot
  AND l.batch = m.batch AND l.entity_id = m.entity_id"""


def progress_rows(spark: SparkSession, sf: str) -> DataFrame:
    results = views.results(spark, sf)
    before = results.where((F.col("kind") == "retention") & F.col("ok"))
    outcome = outcomes.campaign_outcome(results, *RUN)
    return outcomes.progress_rows(outcome, before, *RUN)


PROGRESS_ROWS = f"""{_RESULTS}
SELECT run_day, run_slot, entity_id FROM results GROUP BY ALL
HAVING COUNT(*) FILTER (severity = 'hard') = 0
  OR COUNT(*) FILTER (kind = 'retention' AND ok) > 0"""


def run_stats(spark: SparkSession, sf: str) -> DataFrame:
    return outcomes.run_stats(views.results(spark, sf), *RUN)


_STATS = """
SELECT run_day, run_slot, COUNT(DISTINCT batch * 10 + window_start) AS windows_processed,
  CAST(COALESCE(SUM(row_count) FILTER (ok AND kind = 'breakdown'), 0) AS BIGINT) AS breakdown_rows,
  CAST(COALESCE(SUM(row_count) FILTER (ok AND kind = 'engagement'), 0) AS BIGINT)
    AS engagement_rows,
  CAST(COALESCE(SUM(row_count) FILTER (ok AND kind = 'retention'), 0) AS BIGINT) AS retention_rows,
  COUNT(*) FILTER (severity = 'hard') AS hard_errors,
  COUNT(*) FILTER (severity = 'soft') AS soft_errors,
  COUNT(*) FILTER (severity = 'skip') AS skip_errors
FROM results GROUP BY run_day, run_slot"""

RUN_STATS = f"{_RESULTS} {_STATS}"


def entity_stats(spark: SparkSession, sf: str) -> DataFrame:
    orders = views.table(spark, sf, "orders")
    done = orders.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("entity_id")
    )
    return outcomes.entity_stats(views.entities(spark, sf), done, "incremental", views.AS_OF)


ENTITY_STATS = """
SELECT COUNT(*) AS entities_synced, COUNT(*) FILTER (o_orderstatus = 'F') AS entities_resumed,
  COUNT(*) FILTER (o_orderstatus <> 'F' AND CAST(o_orderdate AS DATE) > DATE '2001-07-27')
    AS entities_skipped
FROM orders"""


def finished_runs(spark: SparkSession, sf: str) -> DataFrame:
    return outcomes.finished_runs(run_stats(spark, sf))


FINISHED_RUNS = f"{_RESULTS} SELECT * FROM ({_STATS}) WHERE hard_errors = 0"


QUERIES = {
    "lookback_windows": (lookback_windows, LOOKBACK_WINDOWS),
    "backfill_windows": (backfill_windows, BACKFILL_WINDOWS),
    "id_batches": (id_batches, ID_BATCHES),
    "batch_windows": (batch_windows, BATCH_WINDOWS),
    "plan_requests": (plan_requests, PLAN_REQUESTS),
    "plan_batch_requests": (plan_batch_requests, PLAN_BATCH_REQUESTS),
    "resume_anti": (resume_anti, RESUME_ANTI),
    "error_classify": (error_classify, ERROR_CLASSIFY),
    "campaign_outcome": (campaign_outcome, CAMPAIGN_OUTCOME),
    "run_outcome": (run_outcome, RUN_OUTCOME),
    "progress_rows": (progress_rows, PROGRESS_ROWS),
    "run_stats": (run_stats, RUN_STATS),
    "entity_stats": (entity_stats, ENTITY_STATS),
    "finished_runs": (finished_runs, FINISHED_RUNS),
}
