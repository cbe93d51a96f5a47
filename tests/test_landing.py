from __future__ import annotations

import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.lab import ingest, views
from tidemark.schemas import campaign_specs, link_specs
from tidemark.session import Scratch
from tidemark.sources import read_entity, read_lines, read_pages

BREAKDOWN = campaign_specs()["breakdown"]


def most_tasks(spark, run) -> int:
    """Tasks of the largest stage that ``run`` started."""
    group, tracker = uuid.uuid4().hex, spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, "listing")
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return max((tracker.getStageInfo(s).numTasks for s in stages), default=0)


@pytest.fixture
def folders(tmp_path):
    for number in range(60):
        folder = tmp_path / "landed" / f"entity={number}"
        folder.mkdir(parents=True)
        (folder / "a.jsonl").write_text('{"data": {}}\n')
    return str(tmp_path / "landed")


def test_folders_are_listed_by_a_few_tasks(spark, folders):
    entities = link_specs()["entities"]
    reads = [
        lambda: read_lines(spark, folders),
        lambda: read_entity(spark, folders, entities),
        lambda: read_pages(spark, folders, entities),
        lambda: jobs._landed_exports(spark, folders),
    ]
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    for read in reads:
        assert 1 < most_tasks(spark, read) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(name) == before


def test_files_of_their_own_are_written_by_all_cores(spark):
    rows = spark.range(200).withColumn("item", F.struct(F.col("id").cast("string").alias("linkId")))
    path = ingest.land_listing(rows.select("id", "item"), "id", F.col("item"), 5)
    tasks = {file.name.split("-")[1] for file in Path(path).glob("page=*/part-*")}
    assert len(list(Path(path).glob("page=*"))) == 40
    assert len(tasks) >= spark.sparkContext.defaultParallelism


def test_landed_text_is_compressed_and_made_after_the_rows_moved(spark):
    rows = spark.range(3000).select("id", (199703 + F.col("id") % 2).alias("ship_month"))
    text = F.to_json(F.struct("id", F.lit("a" * 300).alias("long_name")))
    path = ingest.land(rows, "compressed", text)
    files = list(Path(path).glob("window=*/part-*"))
    assert {file.parent.name for file in files} == {"window=1997-03-01", "window=1997-04-01"}
    assert all(file.name.endswith(".gz") for file in files)
    expected = {row[0] for row in rows.select(text).collect()}
    found = [row["value"] for row in read_lines(spark, path).collect()]
    assert len(found) == 3000 and set(found) == expected
    assert sum(file.stat().st_size for file in files) < 300 * 3000 / 10


def test_orders_meet_their_country_before_lines(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for name in ("lineitem", "orders", "customer", "nation"):
        spark.createDataFrame([], views.TABLES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    plan = views.lines(spark, str(tmp_path), "country")._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert len(joins) == 3 and "l_orderkey" in joins[0]


def test_rejected_exports_do_not_move_the_rows(spark):
    staged = spark.range(1000).select(
        (F.col("id") % 10).cast("string").alias("export"),
        F.when(F.col("id") == 7, F.array(F.lit("x: missing"))).otherwise(F.array().cast("array<string>")).alias("faults"),
        F.lit("text").alias("raw_json"),
    )
    with Scratch(spark) as scratch:
        staged = scratch.pin(staged, "staged")
        good, aside = jobs._sorted_out(staged, None, "reject", scratch)
        assert (good.count(), aside.count()) == (900, 100)
        for rows in (good, aside):
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
