"""Stored sums, periods pruned at run time, and counts observed by the write."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

import pytest

from tidemark.operators import attribution
from tidemark.operators.sieve import sieve, sifted
from tidemark.operators.upsert import upsert
from tidemark.operators.windows import spend_window, within_periods
from tidemark.refresh import engagement_sums, refresh, spend_sums, statement_sums
from tidemark.schemas import STATEMENT, campaign_specs

SPECS = campaign_specs()
FACTS, SPEND = SPECS["engagement"], SPECS["breakdown"]
NOW = datetime(2031, 5, 4)
FIRST, LAST = date(2030, 11, 17), date(2031, 2, 9)


def spent(spark, campaigns=4, days=(FIRST, LAST), amount=0.1):
    rows = [
        ("p", "a", day, f"c{c}", country, amount, 3)
        for c in range(campaigns)
        for day in (days[0] + timedelta(n) for n in range((days[1] - days[0]).days + 1))
        for country in ("SE", "NO")
    ]
    names = "provider string, account_id string, report_date date, campaign_id string, country_code string"
    return spark.createDataFrame(rows, f"{names}, spend_total double, streams bigint")


def engaged(spark, campaigns=4, first=date(2030, 8, 1), days=300):
    rows = [
        ("p", "a", first + timedelta(n), f"c{c}", "playlist", country, f"t{n % 7}", f"Q{n % 7 // 2}", n % 40 or None, n % 11)
        for c in range(campaigns)
        for n in range(0, days, 1 + c)
        for country in ("SE", "NO")
    ]
    names = (
        "provider string, account_id string, report_date date, campaign_id string, engagement_context string, "
        "country_code string, engaged_spotify_track_id string, engaged_track_isrc string"
    )
    return spark.createDataFrame(rows, f"{names}, playlist_position int, streams bigint")


def sold(spark):
    months = [date(2030 + m // 12, m % 12 + 1, 1) for m in range(7, 20)]
    rows = [(f"Q{q}", m, "SE", 100 * q + i, 1.5 * i, "USD") for q in range(4) for i, m in enumerate(months)]
    return spark.createDataFrame(
        rows, "isrc string, month date, country_code string, streams bigint, revenue double, currency string"
    )


@pytest.fixture
def facts(spark, store):
    store.replace(FACTS, engaged(spark))
    store.replace(SPEND, spent(spark))
    store.replace(STATEMENT, sold(spark))
    return store


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert sorted(map(repr, left.select(columns).collect())) == sorted(map(repr, right.select(columns).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


ANALYSES = [attribution.playlist_share, attribution.playlist_recoup, attribution.playlist_periods]


@pytest.mark.parametrize("analysis", ANALYSES)
def test_analyses_of_stored_facts_read_the_months_of_the_windows(facts, analysis):
    spend, statement = facts.read(SPEND), facts.read(STATEMENT)
    pruned = analysis(facts.read(FACTS, with_period=True), spend, statement)
    same(pruned, analysis(facts.read(FACTS), spend, statement))
    if analysis is not attribution.playlist_periods:  # the recordings of a playlist need no window
        assert "dynamicpruning" in plan(pruned)


def test_bands_prune_periods_of_days_too(spark, store):
    daily = FACTS.partitioned_by("day")
    store.replace(daily, engaged(spark))
    store.replace(SPEND, spent(spark))
    pruned = attribution.position_bands(store.read(daily, with_period=True), store.read(SPEND))
    assert "dynamicpruning" in plan(pruned)
    same(pruned, attribution.position_bands(engaged(spark), spent(spark)))


def test_the_scan_is_filtered_by_the_months_of_the_windows(facts):
    windows = spend_window(facts.read(SPEND))
    rows = within_periods(facts.read(FACTS, with_period=True), windows)
    assert re.search(r"PartitionFilters: \[[^]]*dynamicpruning", plan(rows))
    months = {r["period"] for r in rows.select("period").distinct().collect()}
    assert months == {203011, 203012, 203101, 203102}
    assert len(facts.writes(FACTS)) == 10
    nothing = within_periods(facts.read(FACTS, with_period=True), windows.where("false"))
    assert nothing.count() == 0


@pytest.mark.parametrize("grain", ["month", "day"])
def test_refreshed_sums_equal_a_recompute_and_read_changed_periods_only(spark, store, grain):
    spec = SPEND.partitioned_by(grain)
    sums = spend_sums(spec)
    upsert(store, spec, spent(spark), NOW, order=())
    everything = refresh(store, spec, sums)
    assert everything == sorted(store.writes(spec)) and refresh(store, spec, sums) == []

    upsert(store, spec, spent(spark, days=(LAST, LAST + timedelta(30)), amount=0.7), NOW, order=())
    touched = refresh(store, spec, sums)
    late = date(2030, 12, 24)
    upsert(store, spec, spent(spark, campaigns=1, days=(late, late), amount=9.0), NOW, order=())
    assert refresh(store, spec, sums) == [203012 if grain == "month" else 20301224]
    assert touched == [p for p in store.writes(spec) if p >= (203102 if grain == "month" else 20310209)]

    names = [name for name in sums.spec.fields.names]
    same(store.read(sums.spec).select(names), sums.build(store.read(spec)).select(names))
    # Sums of untouched periods keep their files.
    assert len(set(store.writes(sums.spec).values())) == 3


def test_a_period_that_is_gone_takes_its_sums_along(spark, store):
    sums = spend_sums(SPEND)
    store.replace(SPEND, spent(spark))
    refresh(store, SPEND, sums)
    store.replace(SPEND, spent(spark, days=(date(2031, 1, 3), date(2031, 1, 4))))
    assert refresh(store, SPEND, sums) == [203011, 203012, 203101, 203102]
    assert list(store.writes(sums.spec)) == [203101]
    store.replace(SPEND, spent(spark).limit(0))
    assert refresh(store, SPEND, sums) == [203101]
    assert store.read(sums.spec).count() == 0


def test_analyses_are_the_same_on_stored_sums(spark, facts):
    made = {spec.name: build(spec) for spec, build in ((FACTS, engagement_sums), (SPEND, spend_sums), (STATEMENT, statement_sums))}
    for spec in (FACTS, SPEND, STATEMENT):
        refresh(facts, spec, made[spec.name])
    rows, spend, statement = (facts.read(made[s.name].spec) for s in (FACTS, SPEND, STATEMENT))
    assert rows.count() < facts.read(FACTS).count()
    for analysis in ANALYSES:
        same(analysis(rows, spend, statement), analysis(facts.read(FACTS), facts.read(SPEND), facts.read(STATEMENT)))
    same(
        attribution.position_bands(rows, spend),
        attribution.position_bands(facts.read(FACTS), facts.read(SPEND)),
    )


def test_a_sieve_lets_every_listed_key_through_and_few_others(spark):
    listed = spark.range(0, 40_000, 7).selectExpr("cast(id as string) as k").unionByName(
        spark.createDataFrame([(None,)], "k string")
    )
    rows = spark.range(40_000).selectExpr("cast(id as string) as k", "id")
    words = sieve(listed, "k")
    passed = {r["id"] for r in sifted(rows, "k", words).collect()}
    assert set(range(0, 40_000, 7)) <= passed and len(passed) < 40_000 / 7 * 1.05
    tiny = sieve(listed, "k", bits=640)
    assert tiny.count() <= 10 and set(range(0, 40_000, 7)) <= {r["id"] for r in sifted(rows, "k", tiny, 640).collect()}
    assert sifted(rows, "k", sieve(listed.limit(0), "k")).count() == 0


def test_a_sifted_statement_is_filtered_before_it_is_summed(facts):
    spend, statement = facts.read(SPEND), facts.read(STATEMENT)
    few = facts.read(FACTS).where("engaged_track_isrc = 'Q1'")
    plain, sifted_share = (attribution.playlist_share(few, spend, statement, sift=s) for s in (False, True))
    same(plain, sifted_share)
    assert "_mask" in plan(sifted_share) and "_mask" not in plan(plain)
    read = sifted(statement, "isrc", sieve(few.withColumnRenamed("engaged_track_isrc", "isrc"), "isrc"))
    assert 0 < read.count() < statement.count() / 2
