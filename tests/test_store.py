from __future__ import annotations

import json
import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samples import breakdown_line, write_statement
from tidemark import jobs
from tidemark.operators import upsert as merging
from tidemark.operators.upsert import latest_by_key, upsert, write_batch
from tidemark.schemas import LAST_SYNC, PROGRESS, TableSpec, all_specs, campaign_specs, link_specs
from tidemark.sources import SnapshotStore, decode_rows, raw_field, snapshots
from tidemark.sources.snapshots import ConcurrentWrite, evolve, with_period
from tidemark.streaming import late_split, stream_exports

SPEC = campaign_specs()["breakdown"]
NOW = datetime(2031, 3, 12, 4, 30)


def batch(spark, *lines, spec=SPEC):
    texts = [(json.dumps(line), n) for n, line in enumerate(lines)]
    rows = spark.createDataFrame(texts, "value string, line int")
    return decode_rows(rows, spec).drop("faults")


def stored(store, spec=SPEC):
    return {r["country_code"]: r for r in store.read(spec).collect()}


def test_upsert_replaces_the_row_with_its_key(spark, store):
    us, de = breakdown_line(), breakdown_line(country_code="DE")
    assert upsert(store, SPEC, batch(spark, us, de), NOW) == 2
    assert upsert(store, SPEC, batch(spark, {**us, "streams": 999, "followers": None}), NOW) == 1
    rows = stored(store)
    assert len(rows) == 2
    assert (rows["US"]["streams"], rows["US"]["cpl"], rows["US"]["followers"]) == (999, 0.16, None)
    assert rows["DE"]["streams"] == 520
    assert rows["US"]["synced_at"] == NOW


def test_all_link_tables_take_upserts(spark, store):
    for role, spec in link_specs().items():
        if role == "entities":
            continue
        line = {name: "x" for name in spec.key} | {spec.day: "2031-02-01"}
        assert upsert(store, spec, batch(spark, line, spec=spec), NOW) == 1
        assert upsert(store, spec, batch(spark, line, spec=spec), NOW) == 1
        assert store.read(spec).count() == 1


def test_empty_batch_writes_nothing(spark, store):
    store.ensure([SPEC])
    before = store.version(SPEC)
    assert upsert(store, SPEC, batch(spark, breakdown_line()).limit(0), NOW) == 0
    assert store.version(SPEC) == before


def test_last_of_a_batch_wins_and_the_count_is_the_input(spark, store):
    lines = [breakdown_line(streams=n) for n in (5, 9, 7)]
    assert upsert(store, SPEC, batch(spark, *lines), NOW) == 3
    assert stored(store)["US"]["streams"] == 7


def test_untouched_periods_keep_their_files(spark, store):
    upsert(store, SPEC, batch(spark, breakdown_line(report_date="2026-03-31")), NOW)
    march = store._snapshot(SPEC, store.version(SPEC))["periods"]["202603"]
    upsert(store, SPEC, batch(spark, breakdown_line(report_date="2026-04-01")), NOW)
    periods = store._snapshot(SPEC, store.version(SPEC))["periods"]
    assert periods["202603"] == march and periods["202604"] != march
    days = store.read_days(SPEC, date(2026, 4, 1), date(2026, 4, 30))
    assert [str(r["report_date"]) for r in days.collect()] == ["2026-04-01"]
    assert all("period=202604" in name for name in days.inputFiles())
    assert store.read_days(SPEC, start=date(2026, 4, 1)).count() == 1
    assert store.read_days(SPEC, end=date(2026, 3, 31)).count() == 1


def test_partition_by_day(spark, store):
    daily = SPEC.partitioned_by("day")
    lines = [breakdown_line(report_date=f"2026-04-0{n}") for n in (1, 2)]
    upsert(store, daily, batch(spark, *lines), NOW)
    assert set(store._snapshot(daily, store.version(daily))["periods"]) == {"20260401", "20260402"}


def test_a_table_keeps_its_grain(spark, store):
    upsert(store, SPEC, batch(spark, breakdown_line()), NOW)
    with pytest.raises(ValueError, match="stored by month"):
        upsert(store, SPEC.partitioned_by("day"), batch(spark, breakdown_line()), NOW)
    store.replace(SPEC.partitioned_by("day"), store.read(SPEC))
    assert upsert(store, SPEC.partitioned_by("day"), batch(spark, breakdown_line()), NOW) == 1
    assert store.read(SPEC).count() == 1


ROW = st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 100))


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(batches=st.lists(st.lists(ROW, max_size=8), min_size=1, max_size=3))
def test_upsert_equals_a_dictionary(spark, tmp_path_factory, batches):
    store = SnapshotStore(spark, str(tmp_path_factory.mktemp("store")))
    expected = {}
    for rows in batches:
        lines = [
            breakdown_line(
                campaign_id=str(c), report_date=str(date(2026, 3, 31) + timedelta(days=d)), streams=s
            )
            for c, d, s in rows
        ]
        for line in lines:
            expected[(line["campaign_id"], line["report_date"])] = line["streams"]
        if lines:
            for _ in range(2):
                upsert(store, SPEC, batch(spark, *lines), NOW)
    found = [(r["campaign_id"], str(r["report_date"]), r["streams"]) for r in store.read(SPEC).collect()]
    assert sorted(found) == sorted((c, d, s) for (c, d), s in expected.items())


def test_latest_by_key_breaks_ties_by_the_other_columns(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", None, "z")], "k string, n int, v string")
    found = {tuple(r) for r in latest_by_key(rows, ["k"], ["n"]).collect()}
    assert found == {("a", 1, "y"), ("b", None, "z")}


def wide_plan(store, rows, spec=SPEC):
    """The plan by which a batch meets the stored rows."""
    every = store.read(spec, with_period=True).withColumn("_new", F.lit(0)).unionByName(
        evolve(with_period(rows, spec), store.columns(spec), ("period", "line")).withColumn("_new", F.lit(1)),
        allowMissingColumns=True,
    )
    return merging._merged(every, spec, ["line"], {})._jdf.queryExecution().executedPlan().toString()


def test_a_merge_moves_whole_rows_once(spark, store):
    upsert(store, SPEC, batch(spark, breakdown_line()), NOW)
    plan = wide_plan(store, batch(spark, breakdown_line(streams=3)))
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_COL" in plan
    assert "SortAggregate" not in plan and "Join" not in plan
    assert plan.count("Sort [") == 1


def test_a_merge_reports_what_the_write_saw(spark, store):
    lines = [breakdown_line(country_code=c, streams=n) for n, c in enumerate(["US", "DE", "US", "US"])]
    first = write_batch(store, SPEC, batch(spark, *lines), NOW)
    assert (first.given, first.kept, first.stored, first.repeated) == (4, 2, 2, 2)
    second = write_batch(store, SPEC, batch(spark, breakdown_line(country_code="FR"), lines[0]), NOW)
    assert (second.given, second.kept, second.stored) == (2, 2, 3)


def test_a_very_frequent_key_is_reduced_before_it_moves(spark, store, monkeypatch):
    monkeypatch.setattr(merging, "HOT_COPIES", 20)
    reduced = []
    few_copies = merging._few_copies

    def watched(given, key, order, hot):
        left = few_copies(given, key, order, hot)
        reduced.append((len(hot), given.count(), left.count()))
        return left

    monkeypatch.setattr(merging, "_few_copies", watched)
    lines = [breakdown_line(country_code="DE", streams=n) for n in range(60)]
    lines += [breakdown_line(country_code=c, streams=n) for n, c in enumerate(["US", "FR"] * 5)]
    report = write_batch(store, SPEC, batch(spark, *lines), NOW)
    assert reduced == [(1, 70, 11)]
    assert (report.given, report.kept) == (70, 3)
    assert {c: r["streams"] for c, r in stored(store).items()} == {"DE": 59, "US": 8, "FR": 9}


def test_large_periods_are_spread_over_cells(spark, store, conf, monkeypatch):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    monkeypatch.setattr(merging, "CELL_BYTES", 1000)
    lines = [breakdown_line(campaign_id=str(n), streams=n) for n in range(40)]
    upsert(store, SPEC, batch(spark, *lines), NOW)
    upsert(store, SPEC, batch(spark, breakdown_line(campaign_id="7", streams=100)), NOW)
    rows = store.read(SPEC)
    assert len(rows.inputFiles()) > 1
    assert sorted(r["streams"] for r in rows.collect()) == sorted([*range(7), *range(8, 40), 100])


def test_a_numbered_batch_is_taken_once(spark, store):
    one, two = batch(spark, breakdown_line(streams=1)), batch(spark, breakdown_line(streams=2))
    assert upsert(store, SPEC, one, NOW, once=("s", 0)) == 1
    assert upsert(store, SPEC, two, NOW, once=("s", 1)) == 1
    version = store.version(SPEC)
    assert upsert(store, SPEC, one, NOW, once=("s", 0)) == 0 == upsert(store, SPEC, one, NOW, once=("s", 1))
    assert store.version(SPEC) == version and stored(store)["US"]["streams"] == 2
    assert upsert(store, SPEC, one, NOW, once=("other", 0)) == 1
    assert (store.last_batch(SPEC, "s"), store.last_batch(SPEC, "other"), store.last_batch(SPEC, "x")) == (1, 0, -1)
    assert stored(store)["US"]["streams"] == 1


def test_of_writers_of_one_version_at_most_one_publishes(spark, store):
    store.ensure([SPEC])
    base, snapshot = store.version(SPEC), store._snapshot(SPEC, store.version(SPEC))
    published = 0
    for _ in range(5):
        start = threading.Barrier(4)

        def publish(n, version=base + published + 1):
            start.wait()
            try:
                store._publish(SPEC, version, {**snapshot, "notes": {"writer": n}})
            except ConcurrentWrite:
                return None
            return n

        with ThreadPoolExecutor(4) as pool:
            won = [n for n in pool.map(publish, range(4)) if n is not None]
        assert len(won) <= 1
        if won:
            published += 1
            assert store._snapshot(SPEC, base + published)["notes"] == {"writer": won[0]}
    assert store.version(SPEC) == base + published
    store._publish(SPEC, base + published + 1, snapshot)


def test_a_claim_of_a_dead_writer_does_not_block_for_good(spark, store, monkeypatch):
    store.ensure([SPEC])
    left = store._path(SPEC.name, "claims", store.version(SPEC) + 1, "dead")
    store._fs().create(left, False).close()
    with pytest.raises(ConcurrentWrite):
        upsert(store, SPEC, batch(spark, breakdown_line()), NOW)
    monkeypatch.setattr(snapshots, "CLAIM_HOURS", -1.0)
    assert upsert(store, SPEC, batch(spark, breakdown_line()), NOW) == 1


def test_a_batch_that_changes_between_reads_is_not_published(spark, store):
    upsert(store, SPEC, batch(spark, breakdown_line()), NOW)
    rows = with_period(batch(spark, breakdown_line(report_date="2026-05-01")), SPEC)
    before = store.version(SPEC)
    with pytest.raises(RuntimeError, match="not expected"):
        store.write_periods(SPEC, rows, before, only={202604})
    assert store.version(SPEC) == before


def test_new_columns_are_nullable_and_old_ones_stay(spark, store):
    early_fields = [f for f in SPEC.fields if f.name != "cpl"]
    extra = T.StructField("legacy", T.StringType())
    early = TableSpec(SPEC.name, SPEC.key, T.StructType([*early_fields, extra]), SPEC.key, SPEC.day)
    rows = batch(spark, breakdown_line()).withColumn("legacy", F.lit("kept"))
    upsert(store, early, rows, NOW)
    store.ensure([SPEC])
    upsert(store, SPEC, batch(spark, breakdown_line(country_code="DE")), NOW)
    found = stored(store)
    assert (found["US"]["cpl"], found["US"]["legacy"]) == (None, "kept")
    assert (found["DE"]["cpl"], found["DE"]["legacy"]) == (0.16, None)


def test_ensure_creates_all_tables_once(spark, store):
    store.ensure(all_specs())
    store.ensure(all_specs())
    for spec in all_specs():
        assert store.version(spec) == 1
        assert store.read(spec).count() == 0
        assert store.read(spec).columns == spec.stored.names


def test_second_writer_of_a_version_fails(spark, store):
    rows = with_period(batch(spark, breakdown_line()), SPEC)
    store.write_periods(SPEC, rows, 0)
    with pytest.raises(ConcurrentWrite):
        store.write_periods(SPEC, rows, 0)
    assert store.read(SPEC).count() == 1


def test_expire_keeps_what_snapshots_use(spark, store):
    for streams in (1, 2, 3, 4):
        upsert(store, SPEC, batch(spark, breakdown_line(streams=streams)), NOW)
    assert store.expire(SPEC) == []
    assert len(store.expire(SPEC, keep=2, older_than_hours=-1)) == 2
    left = (Path(store.root) / SPEC.name / "snapshots").iterdir()
    assert sorted(p.name for p in left if p.name.isdigit()) == ["3", "4"]
    assert not list((Path(store.root) / SPEC.name / "claims").iterdir())
    assert stored(store)["US"]["streams"] == 4


def test_rows_without_a_day_are_refused_before_writing(spark, store):
    upsert(store, SPEC, batch(spark, breakdown_line()), NOW)
    with pytest.raises(ValueError, match="without report_date"):
        upsert(store, SPEC, batch(spark, breakdown_line(report_date=None, streams=1)), NOW)
    assert stored(store)["US"]["streams"] == 520


def test_a_note_is_kept_as_first_written(store):
    assert store.note("t", "clock", 0, text="monday") == "monday"
    assert store.note("t", "clock", 0, text="tuesday") == "monday"


def test_entities_landed_one_by_one(spark, store, tmp_path):
    from test_ingest import campaign

    for number in (1, 2):
        land(tmp_path / "one", f"{number}.json", {"data": campaign(number), "meta": {}})
    spec = campaign_specs()["entities"]
    assert jobs.load_entities(store, spec, str(tmp_path / "one"), NOW, single=True) == 2
    assert sorted(r["campaign_id"] for r in store.read(spec).collect()) == ["c1", "c2"]
    land(tmp_path / "none", "3.json", {"data": None})
    with pytest.raises(jobs.RejectedLoad):
        jobs.load_entities(store, spec, str(tmp_path / "none"), NOW, single=True)


def test_jobs_leave_no_scratch_tables(spark, store, tmp_path):
    from tidemark.session import scratch_root

    folder = Path(scratch_root(spark)) / "tidemark"
    before = set(folder.iterdir()) if folder.exists() else set()
    path = land(tmp_path / "in", "a.jsonl", breakdown_line(), {"provider": "x"})
    with pytest.raises(jobs.RejectedLoad):
        jobs.load_export(store, SPEC, path, NOW)
    assert set(folder.iterdir()) == before
    report = jobs.load_export(store, SPEC, path, NOW, on_invalid="quarantine")
    assert report.set_aside.count() == 1
    report.discard()
    jobs.load_statement_table(store, write_statement(tmp_path / "s.csv"), NOW)
    assert set(folder.iterdir()) == before


def test_evolve_casts_and_fills(spark):
    rows = spark.createDataFrame([("5",)], "a string")
    wanted = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DateType())])
    shaped = evolve(rows, wanted)
    assert [tuple(r) for r in shaped.collect()] == [(5, None)]
    assert shaped.schema["b"].dataType == T.DateType()


def land(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    texts = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    (folder / name).write_text("\n".join(texts) + "\n")
    return str(folder)


def test_load_export_modes(spark, tmp_path):
    folder = tmp_path / "landing"
    land(folder, "good.jsonl", breakdown_line(), breakdown_line(country_code="DE"))
    path = land(folder, "bad.jsonl", breakdown_line(country_code="FR"), {"provider": "demo"})
    stores = {m: SnapshotStore(spark, str(tmp_path / m)) for m in ("fail", "reject", "quarantine")}
    with pytest.raises(jobs.RejectedLoad):
        jobs.load_export(stores["fail"], SPEC, path, NOW)
    assert stores["fail"].read(SPEC).count() == 0
    report = jobs.load_export(stores["reject"], SPEC, path, NOW, on_invalid="reject")
    assert (report.rows, report.set_aside.count()) == (2, 2)
    assert set(stored(stores["reject"])) == {"US", "DE"}
    report = jobs.load_export(stores["quarantine"], SPEC, path, NOW, on_invalid="quarantine")
    assert (report.rows, report.set_aside.count()) == (3, 1)
    assert set(stored(stores["quarantine"])) == {"US", "DE", "FR"}


def test_load_export_checks_declared_counts(spark, tmp_path, store):
    path = land(tmp_path / "landing", "a.jsonl", breakdown_line(schema_version="1.1"))
    named = F.element_at(F.split("file", "/"), -1)
    wrong = spark.createDataFrame([("a.jsonl", 2)], "export string, expected int")
    right = spark.createDataFrame([("a.jsonl", 1)], "export string, expected int")
    with pytest.raises(jobs.RejectedLoad):
        jobs.load_export(store, SPEC, path, NOW, manifest=wrong, export=named)
    report = jobs.load_export(store, SPEC, path, NOW, manifest=right, export=named)
    assert report.rows == 1
    assert [tuple(r) for r in report.drift.collect()] == [("1.1", 1)]
    outside = jobs.load_export(store, SPEC, path, NOW, start=date(2026, 5, 1))
    assert outside.rows == 0


def test_load_entities(spark, tmp_path, store):
    from test_ingest import campaign, write_pages

    spec = campaign_specs()["entities"]
    path = write_pages(tmp_path / "p", {1: [campaign(1), campaign(2)]}, 2)
    assert jobs.load_entities(store, spec, path, NOW) == 2
    assert jobs.load_entities(store, spec, path, NOW) == 2
    rows = store.read(spec).select(F.get_json_object("raw_json", "$.campaignId").alias("id"))
    assert sorted(r["id"] for r in rows.collect()) == ["c1", "c2"]
    short = write_pages(tmp_path / "q", {1: [campaign(1)]}, 2)
    with pytest.raises(jobs.RejectedLoad, match="incomplete"):
        jobs.load_entities(store, spec, short, NOW)


RESULT = (
    "batch string, entity_id string, window_start int, kind string, ok boolean, status int, "
    "message string, body string, rows bigint"
)


def test_closing_runs(spark, store):
    store.ensure([PROGRESS, LAST_SYNC])
    day = NOW.date()
    outcome = spark.createDataFrame([("c1", True), ("c2", False)], "entity_id string, completed boolean")
    bad = spark.createDataFrame([("c2", "c2", 0, "breakdown", False, 500, "x", None, 0)], RESULT)
    good = spark.createDataFrame([("c2", "c2", 0, "breakdown", True, 200, None, None, 7)], RESULT)
    args = (store, "campaigns", "full", day, 2)

    assert not jobs.close_run(*args, bad, outcome, NOW)
    assert [r["entity_id"] for r in jobs.completed_ids(store, "campaigns", "full", day).collect()] == ["c1"]
    assert store.read(LAST_SYNC).count() == 0

    assert not jobs.close_run(*args, bad, outcome, NOW, single_id="c9")
    assert jobs.close_run(*args, good, outcome, NOW, single_id="c9")
    assert jobs.completed_ids(store, "campaigns", "full", day).count() == 1

    assert jobs.close_run(*args, good, outcome, NOW)
    last = store.read(LAST_SYNC).first()
    assert (last["sync_key"], last["breakdown_rows"], last["single_id"]) == ("last_sync", 7, None)
    assert jobs.completed_ids(store, "campaigns", "full", day).count() == 0


def test_late_split(spark):
    rows = spark.createDataFrame(
        [(date(2031, 3, 3),), (date(2031, 3, 2),), (None,)], "report_date date"
    )
    fresh, late = late_split(rows, "report_date", NOW.date())
    assert (fresh.count(), late.count()) == (1, 2)


def test_stream_ingest_and_replay(spark, store, tmp_path):
    def run(checkpoint):
        query = stream_exports(
            spark, str(landing), store, SPEC, str(tmp_path / checkpoint), lambda: NOW
        )
        query.awaitTermination()

    landing = tmp_path / "landing"
    fresh = breakdown_line(report_date="2031-03-11")
    old = breakdown_line(report_date="2026-01-01")
    land(landing, "1.jsonl", fresh, "", old, "broken", {**fresh, "country_code": "DE"})
    run("one")
    assert {c: r["streams"] for c, r in stored(store).items()} == {"US": 520, "DE": 520}
    aside = spark.read.parquet(f"{store.root}/{SPEC.name}/aside/one")
    assert sorted(r["reason"] for r in aside.select("reason").collect()) == ["faulty", "late"]

    land(landing, "2.jsonl", {**fresh, "streams": 999})
    run("one")
    assert {c: r["streams"] for c, r in stored(store).items()} == {"US": 999, "DE": 520}
    before = sorted(map(str, store.read(SPEC).collect()))
    run("two")
    assert sorted(map(str, store.read(SPEC).collect())) == before


def export(folder, kind, *parts, lines):
    target = folder / kind
    for part in parts:
        target = target / part
    target.mkdir(parents=True)
    return land(target, "rows.jsonl", *lines)


def link_item(name, created="2031-02-01T10:00:00Z"):
    return {
        "linkId": name, "organizationId": "o", "name": name, "url": "u", "status": "active",
        "createdAt": created,
    }


def link_line(spec, name, **changes):
    values = {column: "x" for column in (*spec.key, "schema_version")}
    return {**values, spec.day: "2031-03-11", "link_id": name, "streams": 1, **changes}


def test_link_run_end_to_end(spark, store, tmp_path):
    from test_ingest import write_pages

    specs = link_specs()
    names = ["a", "b", "c", "d"]
    landing = tmp_path / "landing"
    landing.mkdir()
    future = link_item("later", "2031-03-13T00:00:00Z")
    late = link_item("late", "2031-03-13T00:00:00Z")
    write_pages(landing / "entities", {1: [link_item(n) for n in names[:2]],
                                       2: [link_item(n) for n in names[2:]], 3: [future, late]}, 6)
    window = "window=2031-03-03"
    breakdown, engaged, cohort = specs["breakdown"], specs["engagement"], specs["retention"]
    export(landing, "breakdown", "batch=0", window, lines=[link_line(breakdown, n) for n in "ab"])
    export(landing, "breakdown", "batch=1", window,
           lines=[link_line(breakdown, "c"), {"provider": "x"}])
    export(landing, "retention", "batch=0", window, lines=[link_line(cohort, "a", cohort_date="?")])
    for batch_id, name in (("0", "a"), ("1", "c"), ("1", "d")):
        export(landing, "engagement", f"batch={batch_id}", f"entity={name}", window,
               lines=[link_line(engaged, name)])
    failed = {"kind": "engagement", "batch": "0", "entity_id": "b", "window_start": "2031-03-03",
              "status": 500, "message": "gone"}
    land(landing / "errors", "e.jsonl", failed)

    # Nothing was streamed over this link: its export has no rows. The count of another is wrong.
    export(landing, "engagement", "batch=0", "entity=none", window, lines=[])
    export(landing, "engagement", "batch=0", "entity=short", window, lines=[link_line(engaged, "a")])
    land(landing / "counts", "c.jsonl", {"kind": "engagement", "batch": "0", "entity_id": "short",
                                         "window_start": "2031-03-03", "expected": 2})
    # A link of the batch that was created after the run's day and failed is no idle link.
    land(landing / "errors", "f.jsonl", {**failed, "entity_id": "late"})
    args = (store, "links", specs, str(landing), "full", NOW.date(), NOW)
    report = jobs.sync_landing(*args, waves=3)
    assert not report.finished
    rows = [(r["entity_id"], r["completed"]) for r in report.outcome.collect()]
    found = dict(rows)
    assert len(rows) == len(found)
    assert found == {"a": True, "b": False, "none": True, "short": False, "late": False, "later": True}
    (landing / "errors" / "f.jsonl").write_text("")
    (landing / "counts" / "c.jsonl").write_text("")
    assert tuple(report.entities.first()) == (6, 0, 1)
    assert store.read(specs["entities"]).count() == 6
    assert sorted(r["link_id"] for r in store.read(breakdown).collect()) == ["a", "b"]
    assert [r["link_id"] for r in store.read(engaged).collect()] == ["a"]
    assert store.read(cohort).count() == 0
    progress = jobs.completed_ids(store, "links", "full", NOW.date())
    assert sorted(r["entity_id"] for r in progress.collect()) == ["a", "later", "none"]

    (landing / "errors" / "e.jsonl").write_text("")
    (landing / "breakdown" / "batch=1" / window / "rows.jsonl").write_text(
        json.dumps(link_line(breakdown, "c")) + "\n"
    )
    export(landing, "engagement", "batch=0", "entity=b", window, lines=[link_line(engaged, "b")])
    again = jobs.sync_landing(*args)
    assert again.finished
    assert tuple(again.entities.first()) == (6, 2, 1)
    drift = {kind: [tuple(r) for r in rows.collect()] for kind, rows in again.drift.items()}
    assert drift == {"breakdown": [("x", 3)], "engagement": [("x", 5)], "retention": [("x", 1)]}
    last = store.read(LAST_SYNC).first()
    assert (last["sync_key"], last["entities"], last["soft_error_count"]) == ("last_sync_links", 6, 1)
    assert (last["breakdown_rows"], last["engagement_rows"]) == (3, 5)
    assert jobs.completed_ids(store, "links", "full", NOW.date()).count() == 0


def test_campaign_run_end_to_end(spark, store, tmp_path):
    from test_ingest import campaign, write_pages

    specs = campaign_specs()
    landing = tmp_path / "landing"
    landing.mkdir()
    write_pages(landing / "entities", {1: [campaign(1), campaign(2)]}, 2)
    for start, day in (("2026-01-15", "2026-02-01"), ("2026-04-15", "2026-05-01")):
        for name in ("c1", "c2"):
            lines = [breakdown_line(campaign_id=name, report_date=day)]
            if (name, start) == ("c2", "2026-04-15"):
                lines.append({"provider": "demo"})
            export(landing, "breakdown", f"entity={name}", f"window={start}", lines=lines)
    report = jobs.sync_landing(
        store, "campaigns", specs, str(landing), "full", date(2026, 6, 1), NOW
    )
    assert not report.finished
    assert {r["entity_id"]: r["completed"] for r in report.outcome.collect()} == {
        "c1": True,
        "c2": False,
    }
    loaded = store.read(specs["breakdown"]).select("campaign_id", "report_date").collect()
    assert sorted((r[0], str(r[1])) for r in loaded) == [
        ("c1", "2026-02-01"),
        ("c1", "2026-05-01"),
        ("c2", "2026-02-01"),
    ]


def test_statement_table_is_replaced_whole(spark, store, tmp_path):
    from tidemark.schemas import STATEMENT

    from samples import COLUMNS, SOLD

    path = write_statement(tmp_path / "s.csv")
    total = (12, sum(map(sum, SOLD.values())))
    for _ in range(2):
        jobs.load_statement_table(store, path, NOW)
        rows = store.read(STATEMENT)
        assert (rows.count(), rows.agg(F.sum("streams")).first()[0]) == total
    other = write_statement(tmp_path / "t.csv", tuple(reversed(COLUMNS)))
    with pytest.raises(jobs.RejectedLoad):
        jobs.load_statement_table(store, other, NOW, "Nowhere")
    assert store.read(STATEMENT).count() == 12


def test_source_items_kept_as_variant(spark, store):
    spec = SPEC.with_variant()
    lines = [breakdown_line(country_code=c, extra={"k": n, "t": "x"}) for n, c in enumerate(["US", "DE"])]
    upsert(store, spec, batch(spark, *lines, spec=spec), NOW)
    upsert(store, spec, batch(spark, {**lines[0], "extra": {"k": 9}}, spec=spec), NOW)
    rows = store.read(spec)
    found = rows.select("country_code", raw_field(rows, "$.extra.k", "int").alias("k"), raw_field(rows, "$.extra.t").alias("t"))
    assert {tuple(r) for r in found.collect()} == {("US", 9, None), ("DE", 1, "x")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "parse_json" not in plan and "get_json_object" not in plan
    text = batch(spark, *lines)
    assert sorted(r[0] for r in text.select(raw_field(text, "$.extra.k", "int")).collect()) == [0, 1]
    with pytest.raises(ValueError, match="stored as variant"):
        upsert(store, SPEC, batch(spark, *lines), NOW)


def test_a_broken_line_has_no_variant(spark):
    spec = SPEC.with_variant()
    rows = decode_rows(spark.createDataFrame([("{oops",)], "value string"), spec).collect()
    assert (rows[0]["raw_json"], rows[0]["faults"]) == (None, ["undecodable"])
