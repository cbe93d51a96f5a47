from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import upsert as merging
from tidemark.schemas import campaign_specs

BREAKDOWN = campaign_specs()["breakdown"]
SYNCED = datetime(2026, 5, 1)


def batch(spark, rows):
    day = F.date_add(F.lit(date(2026, 4, 1)), (F.col("id") % 60).cast("int"))
    return spark.range(rows).select(
        F.lit("p").alias("provider"),
        F.lit("a").alias("account_id"),
        day.alias("report_date"),
        F.col("id").cast("string").alias("campaign_id"),
        F.lit("DE").alias("country_code"),
        F.repeat(F.lit("text"), 20).alias("raw_json"),
        F.lit("f").alias("file"),
        F.lit(0).cast("bigint").alias("block"),
        F.col("id").alias("line"),
    )


@pytest.mark.parametrize("bytes_a_task", [16 << 20, 5000])
def test_a_batch_is_sorted_by_as_many_tasks_as_its_size_asks_for(spark, store, conf, monkeypatch, bytes_a_task):
    conf(spark__sql__shuffle__partitions="2")
    monkeypatch.setattr(merging, "TASK_BYTES", bytes_a_task)
    merged = []

    def spy(*args):
        merged.append(whole(*args))
        return merged[-1]

    whole = merging._merged
    monkeypatch.setattr(merging, "_merged", spy)
    assert merging.upsert(store, BREAKDOWN, batch(spark, 600), SYNCED) == 600
    plan = merged[0]._jdf.queryExecution().sparkPlan().toString()
    tasks = 1 + 600 * merging.ROW_BYTES // bytes_a_task
    assert plan.count("hashpartitioning(period") == 1
    assert (f", {tasks}), REPARTITION_BY_NUM" in plan) == (tasks > 2)
    assert store.read(BREAKDOWN).select("campaign_id").distinct().count() == 600
