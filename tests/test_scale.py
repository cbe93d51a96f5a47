"""Plans and results when one key holds much of the data or nothing may be broadcast."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import attribution, spread, windows
from tidemark.operators.retention import cohort_retention, retention_long
from tidemark.operators.spread import counted, spread_join

CAMPAIGNS = 20_000


@pytest.fixture
def hot(spark):
    """Every campaign touches recording 0, and campaign 0 has a third of all engagement."""
    wide = spark.range(CAMPAIGNS * 3).select(
        (F.col("id") % CAMPAIGNS).alias("campaign_id"),
        F.when(F.col("id") < CAMPAIGNS, 0).otherwise(F.col("id") % 1000).alias("code"),
        F.col("id"),
    )
    deep = spark.range(CAMPAIGNS * 3 // 2).select(
        F.lit(0).cast("bigint").alias("campaign_id"), (F.col("id") % 1000).alias("code"), "id"
    )
    day = F.date_add(F.lit(date(2026, 8, 10)), (F.col("id") % 20).cast("int"))
    engagement = wide.unionByName(deep).select(
        "campaign_id",
        F.col("code").alias("engaged_track_isrc"),
        F.lit("playlist").alias("engagement_context"),
        day.alias("report_date"),
        F.lit(5).cast("bigint").alias("streams"),
        F.lit(1).alias("playlist_position"),
    )
    spend_days = F.array(F.lit(date(2026, 8, 1)), F.lit(date(2026, 9, 1)))
    spend = spark.range(CAMPAIGNS).select(
        F.col("id").alias("campaign_id"),
        F.explode(spend_days).alias("report_date"),
        F.lit(1.0).alias("spend_total"),
    )
    months = F.array(*[F.lit(date(2026, m, 1)) for m in (7, 8, 9, 10)])
    statement = spark.range(1000).select(
        F.col("id").alias("isrc"),
        F.explode(months).alias("month"),
        F.lit(100).cast("bigint").alias("streams"),
        F.lit(2.0).alias("revenue"),
        F.lit("USD").alias("currency"),
    )
    return engagement, spend, statement


ANALYSES = {
    "share": attribution.playlist_share,
    "periods": attribution.playlist_periods,
    "recoup": attribution.playlist_recoup,
}


@pytest.mark.parametrize("limit", [500_000, -1])
@pytest.mark.parametrize("name", ANALYSES)
def test_hot_recording_is_split_and_results_agree(spark, conf, hot, name, limit, monkeypatch):
    def summed():
        df = ANALYSES[name](*hot)
        numbers = [F.sum(c).cast("decimal(38,4)") for c, t in df.dtypes if t in ("bigint", "double")]
        result = df.agg(F.count("*"), *numbers)
        row = tuple(result.collect()[0])
        return row, result._jdf.queryExecution().executedPlan().toString()

    expected, _ = summed()
    monkeypatch.setattr(spread, "BROADCAST_ROWS", limit)
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__shuffle__partitions="16",
    )
    found, plan = summed()
    assert found == expected
    assert "SortMergeJoin(skew=true)" in plan
    assert ("_salt" in plan) == (limit < 0)


def test_hot_campaign_spreads_over_tasks(spark, conf, hot, monkeypatch):
    monkeypatch.setattr(spread, "BROADCAST_ROWS", -1)
    engagement, spend, _ = hot
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="32",
    )
    mine = engagement.where(F.col("campaign_id") == 0).withColumn("row", F.monotonically_increasing_id())
    lookup = counted(windows.spend_window(spend))
    joined = spread_join(mine, lookup, "campaign_id", ("row",))
    tasks = joined.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 8
    assert sum(r["count"] for r in tasks) == mine.count()


@pytest.mark.parametrize("limit", [500_000, -1])
def test_spread_join_keeps_unmatched_rows_of_a_left_join(spark, limit, monkeypatch):
    monkeypatch.setattr(spread, "BROADCAST_ROWS", limit)
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    lookup = spark.createDataFrame([(1, "x")], "k int, w string")
    found = spread_join(facts, counted(lookup), "k", ("v",), how="left").collect()
    assert {tuple(r) for r in found} == {(1, "a", "x"), (2, "b", None), (None, "c", None)}


def test_few_windows_filter_the_facts_before_any_shuffle(hot):
    engagement, spend, statement = hot
    share = attribution.playlist_share(engagement, spend, statement)
    plan = share._jdf.queryExecution().executedPlan().toString()
    join = plan.index("BroadcastHashJoin [campaign_id")
    below = plan[join : plan.index("BroadcastExchange", join)]
    assert "Exchange" not in below and "Aggregate" not in below


EVENTS = "user_id int, day date, joins boolean, streams bigint"


def brute_retention(events, as_of, days=7):
    joined, active, plays = {}, {}, {}
    for user, day, joins, streams in events:
        if joins:
            joined[user] = min(day, joined.get(user, day))
        active.setdefault(user, set()).add(day)
        plays[user, day] = plays.get((user, day), 0) + streams
    result = {}
    for cohort in set(joined.values()):
        users = [u for u, day in joined.items() if day == cohort]
        firsts = []
        for user in users:
            later = [(d - cohort).days for d in active[user] if 0 < (d - cohort).days <= days]
            firsts.append(min(later, default=None))
        row = []
        for n in range(1, days + 1):
            day = cohort + timedelta(days=n)
            if day >= as_of:
                row += [None, None, None]
                continue
            so_far = sum(f is not None and f <= n for f in firsts)
            row += [firsts.count(n), round(so_far / len(users), 4)]
            row.append(sum(plays.get((u, day), 0) for u in users))
        result[cohort] = (len(users), *row)
    return result


def test_retention_against_brute_force(spark):
    start = date(2026, 8, 1)
    events = [
        (n % 17, start + timedelta(days=n * 7 % 23), n % 5 == 0, n % 4) for n in range(400)
    ]
    as_of = date(2026, 8, 12)
    wide = cohort_retention(spark.createDataFrame(events, EVENTS), as_of)
    found = {r["cohort_date"]: tuple(r)[1:] for r in wide.collect()}
    assert found == brute_retention(events, as_of)
    assert retention_long(wide, "cohort_date").count() == 7 * len(found)


def test_stored_tables_are_read_narrow_and_filtered(spark, store, conf):
    conf(spark__sql__maxMetadataStringLength="2000")
    import samples
    from tidemark.operators.upsert import upsert
    from tidemark.schemas import campaign_specs
    from tidemark.sources.snapshots import evolve

    specs = campaign_specs()
    rows = samples.engagement(spark, samples.ON_PLAYLIST, "playlist").withColumns(
        {name: F.lit("x") for name in ("provider", "account_id", "raw_json")}
    )
    spend = samples.spend(spark).withColumns(
        {name: F.lit("x") for name in ("provider", "account_id", "raw_json")}
    )
    for role, batch in (("engagement", rows), ("breakdown", spend)):
        upsert(store, specs[role], evolve(batch, specs[role].stored), datetime(2026, 9, 20))
    statement = spark.createDataFrame(
        [("Q1", date(2025, 3, 1), 1500)], "isrc string, month date, streams bigint"
    )
    share = attribution.playlist_share(
        store.read(specs["engagement"]), store.read(specs["breakdown"]), statement
    ).where("campaign_id = 'north'")
    assert [r["campaign_streams"] for r in share.collect()] == [180]
    plan = share._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 2
    assert not [line for line in scans if "raw_json" in line or "provider" in line]
    assert all("EqualTo(campaign_id,north)" in line for line in scans)
    assert "EqualTo(engagement_context,playlist)" in "".join(scans)


def test_counting_rows_of_a_batch_with_a_hot_key(spark, store):
    from tidemark.operators.upsert import upsert
    from tidemark.schemas import PROGRESS

    rows = spark.range(30_000).select(
        F.lit("run").alias("run_key"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("entity_id"),
        F.col("id").alias("error_count"),
    )
    assert upsert(store, PROGRESS, rows, datetime(2026, 9, 20), order=("error_count",)) == 30_000
    stored = store.read(PROGRESS)
    assert stored.count() == 20_001
    assert stored.where("entity_id = 'hot'").first()["error_count"] == 29_997


def test_rows_in_a_window_do_not_depend_on_how_many_windows(spark, monkeypatch):
    import samples
    from tidemark.operators import windows

    rows = samples.engagement(spark, samples.ON_PLAYLIST, "playlist")
    found = []
    for limit in (500_000, -1):
        monkeypatch.setattr(spread, "BROADCAST_ROWS", limit)
        found.append(
            windows.within_window(rows, windows.spend_window(samples.spend(spark)), ("report_date",))
        )
    few, many = found
    assert few.columns == many.columns == [*rows.columns, "first_day", "last_day"]
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))
    assert few.count() == 25 * 3 * len(samples.ON_PLAYLIST)


def test_a_lookup_is_counted_by_the_job_that_writes_it(spark, conf):
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    assert counted(rows).small and counted(rows.where("id < 0")).rows.count() == 0
    assert counted(rows.where("false")).small and counted(rows.limit(0)).small
    lookup = counted(rows.groupBy("v").count())
    assert counted(lookup) is lookup and lookup.rows.count() == 7


def test_a_lookup_over_the_bound_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(spread, "BROADCAST_ROWS", 10)
    assert counted(spark.range(10)).small and not counted(spark.range(11)).small


def test_retention_needs_no_window_and_takes_many_users(spark, monkeypatch):
    start = date(2030, 2, 20)
    events = [(n % 41 if n % 3 else 0, start + timedelta(days=n * 5 % 19), n % 4 == 1, n % 6) for n in range(900)]
    rows, as_of = spark.createDataFrame(events, EVENTS), date(2030, 3, 7)
    expected = brute_retention(events, as_of)
    for bound in (500_000, 0):
        monkeypatch.setattr(spread, "BROADCAST_ROWS", bound)
        wide = cohort_retention(rows, as_of)
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and ("BroadcastHashJoin" in plan) == (bound > 0)
        assert {r["cohort_date"]: tuple(r)[1:] for r in wide.collect()} == expected
    with pytest.raises(ValueError, match="at most"):
        cohort_retention(rows, as_of, days=63)
