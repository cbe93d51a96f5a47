from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.plans import outcomes, requests, windows

TODAY = date(2031, 3, 12)


def entities(spark, created: dict, by="entity_id"):
    return spark.createDataFrame(list(created.items()), f"{by} string, created_date date")


def ranges(df):
    return sorted((str(r["window_start"]), str(r["window_end"])) for r in df.collect())


@pytest.mark.parametrize("days", [1, 2, 14, 90])
def test_a_lookback_has_as_many_days_as_asked(days):
    start, end = windows.lookback_range(TODAY, days)
    assert end == TODAY and (end - start).days + 1 == days


def test_a_lookback_of_no_days_is_refused():
    with pytest.raises(ValueError, match=">= 1"):
        windows.lookback_range(TODAY, 0)


def test_a_backfill_is_cut_from_the_creation_on(spark):
    # 207 days, over the end of a leap year's February.
    first, last = date(2027, 11, 5), date(2028, 5, 29)
    found = ranges(windows.backfill_windows(entities(spark, {"a": first}), last))
    assert found == [("2027-11-05", "2028-02-02"), ("2028-02-03", "2028-05-02"), ("2028-05-03", "2028-05-29")]


def test_a_range_that_ends_before_it_starts_is_an_error(spark):
    rows = spark.createDataFrame([(TODAY, TODAY - timedelta(1))], "a date, b date")
    with pytest.raises(Exception, match="before it starts"):
        windows.slice_ranges(rows, "a", "b").collect()


def test_a_lookback_starts_no_earlier_than_the_entity(spark):
    age = {"born today": 0, "younger": 6, "as old": 9, "older": 700, "not yet": -1}
    rows = entities(spark, {name: TODAY - timedelta(days) for name, days in age.items()})
    found = {r["entity_id"]: r for r in windows.lookback_windows(rows, TODAY, 10).collect()}
    assert set(found) == {"born today", "younger", "as old", "older"}
    for name, row in found.items():
        assert row["window_end"] == TODAY
        assert (TODAY - row["window_start"]).days == min(age[name], 9)
    assert windows.backfill_windows(rows.where("entity_id = 'not yet'"), TODAY).count() == 0


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    start=st.dates(date(2013, 5, 1), date(2033, 1, 1)),
    length=st.integers(0, 900),
    size=st.integers(1, 120),
)
def test_slices_tile_the_range(spark, start, length, size):
    end = start + timedelta(days=length)
    rows = spark.createDataFrame([(start, end)], "a date, b date")
    found = sorted(tuple(r) for r in windows.slice_ranges(rows, "a", "b", size).collect())
    covered = [
        first + timedelta(days=n) for first, last in found for n in range((last - first).days + 1)
    ]
    assert covered == [start + timedelta(days=n) for n in range(length + 1)]
    assert all((last - first).days < size for first, last in found)


def test_batch_windows_ignore_creation_when_incremental(spark):
    members = entities(spark, {"a": TODAY - timedelta(3), "b": TODAY - timedelta(120)})
    members = members.withColumn("batch", F.lit(0))
    assert ranges(windows.batch_windows(members, "incremental", TODAY)) == [
        ("2031-03-03", "2031-03-12")
    ]
    full = ranges(windows.batch_windows(members, "full", TODAY))
    assert (full[0][0], full[-1][1]) == ("2030-11-12", "2031-03-12") and len(full) == 2


def test_batches_of_fifty(spark):
    rows = spark.range(120).select(F.format_string("id%03d", "id").alias("entity_id"))
    batches = requests.id_batches(rows, "entity_id")
    found = {r["batch"]: r["n"] for r in batches.groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert found == {0: 50, 1: 50, 2: 20}
    first = batches.groupBy("batch").agg(F.min("entity_id").alias("first")).orderBy("batch").collect()
    assert [r["first"] for r in first] == ["id000", "id050", "id100"]


@pytest.mark.parametrize("count", [0, 1, 1000])
def test_numbered_is_a_total_order(spark, count):
    rows = spark.range(count).select((F.col("id") * 7919 % 1009).alias("k"), "id")
    found = requests.numbered(rows, "k", "id").orderBy("position").collect()
    assert [r["position"] for r in found] == list(range(count))
    assert [(r["k"], r["id"]) for r in found] == sorted((r["k"], r["id"]) for r in found)


def test_campaign_plan(spark):
    rows = entities(spark, {"c1": TODAY - timedelta(100), "c2": TODAY + timedelta(30)}, "campaign_id")
    plan = requests.plan_campaign_requests(rows, "full", TODAY).collect()
    kinds = [(r["campaign_id"], r["kind"], r["status"]) for r in plan]
    assert sorted(kinds, key=str) == [
        ("c1", "breakdown", "planned"),
        ("c1", "breakdown", "planned"),
        ("c1", "engagement", "planned"),
        ("c1", "engagement", "planned"),
        ("c2", None, "skipped"),
    ]


def test_link_plan(spark):
    created = {f"l{n}": TODAY for n in range(3)}
    members = entities(spark, created, "link_id").withColumn("batch", F.lit(0))
    plan = requests.plan_link_requests(members, "incremental", TODAY).collect()
    assert sorted((r["link_id"] or "", r["kind"]) for r in plan) == [
        ("", "breakdown"),
        ("", "retention"),
        ("l0", "engagement"),
        ("l1", "engagement"),
        ("l2", "engagement"),
    ]
    late = members.withColumn("created_date", F.lit(TODAY + timedelta(12)))
    skipped = requests.plan_link_requests(late, "full", TODAY).collect()
    assert [(r["batch"], r["kind"], r["status"]) for r in skipped] == [(0, None, "skipped")]


def test_pending_entities(spark):
    rows = entities(spark, {"a": TODAY, "b": TODAY})
    done = spark.createDataFrame([("a",)], "entity_id string")
    assert [r["entity_id"] for r in requests.pending_entities(rows, done, "entity_id").collect()] == ["b"]


RESULT = (
    "batch int, entity_id string, window_start int, kind string, ok boolean, status int, "
    "message string, body string, rows bigint"
)


def results(spark, *rows):
    return spark.createDataFrame(list(rows), RESULT)


def test_error_classes(spark):
    code = '{"code":"premium_plan_required"}'
    rows = results(
        spark,
        (0, None, 0, "retention", True, 200, None, None, 5),
        (0, None, 1, "retention", False, 403, "x", code, 0),
        (0, None, 2, "retention", False, 403, "PREMIUM_PLAN_REQUIRED", None, 0),
        (0, None, 3, "retention", False, 403, "forbidden", None, 0),
        (0, None, 4, "retention", False, 500, "x", code, 0),
        (0, None, 5, "breakdown", False, 403, "x", code, 0),
    )
    found = outcomes.classify_errors(rows).orderBy("window_start").collect()
    assert [r["severity"] for r in found] == [None, "skip", "skip", "soft", "soft", "hard"]


def test_any_failed_window_fails_a_campaign(spark):
    rows = results(
        spark,
        (1, "c1", 0, "breakdown", True, 200, None, None, 5),
        (1, "c1", 1, "engagement", False, 500, "x", None, 0),
        (2, "c2", 0, "breakdown", True, 200, None, None, 5),
    )
    found = {r["entity_id"]: r["completed"] for r in outcomes.campaign_outcome(rows).collect()}
    assert found == {"c1": False, "c2": True}


def test_link_failure_rules(spark):
    members = spark.createDataFrame(
        [(b, f"l{b}{n}") for b in range(4) for n in range(2)], "batch int, entity_id string"
    )
    rows = results(
        spark,
        # Batch 0: one member's engagement fails.
        (0, None, 0, "breakdown", True, 200, None, None, 9),
        (0, "l00", 0, "engagement", False, 500, "x", None, 0),
        (0, "l01", 0, "engagement", True, 200, None, None, 3),
        # Batch 1: the breakdown fails in the second window.
        (1, None, 0, "breakdown", True, 200, None, None, 9),
        (1, None, 1, "breakdown", False, 500, "x", None, 0),
        # Batch 2: only retention fails.
        (2, None, 0, "breakdown", True, 200, None, None, 9),
        (2, None, 0, "retention", False, 500, "x", None, 0),
        # Batch 3: engagement after the breakdown failure was never requested.
        (3, None, 0, "breakdown", False, 500, "x", None, 0),
        (3, "l30", 1, "engagement", False, 500, "x", None, 0),
    )
    found = {r["entity_id"]: r for r in outcomes.link_outcome(members, rows).collect()}
    completed = sorted(name for name, r in found.items() if r["completed"])
    assert completed == ["l01", "l20", "l21"]
    assert not found["l30"]["engagement_failed"] and found["l30"]["batch_failed"]
    before = spark.createDataFrame([("l20",), ("old",)], "entity_id string")
    progress = outcomes.progress_rows(outcomes.link_outcome(members, rows), before)
    assert [r["entity_id"] for r in progress.collect()] == ["l01", "l20", "l21", "old"]
    stats = outcomes.run_stats(rows).first()
    assert (stats["hard_errors"], stats["soft_errors"], stats["breakdown_rows"]) == (4, 1, 27)
    assert stats["windows_processed"] == 6


def test_run_keys():
    assert outcomes.run_key("campaigns", "full", TODAY) == "run:full:2031-03-12"
    assert outcomes.run_key("links", "incremental", TODAY) == "run:links:incremental:2031-03-12"
    assert outcomes.last_sync_key("campaigns") == "last_sync"
    assert outcomes.last_sync_key("links") == "last_sync_links"
