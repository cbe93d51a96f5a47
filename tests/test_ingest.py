from __future__ import annotations

import json
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from samples import breakdown_line
from tidemark.operators.quality import fault_report, identity_report, repeated_keys, version_report
from tidemark.operators.units import unit_metrics
from tidemark.schemas import all_specs, campaign_specs, link_specs
from tidemark.sources import (
    EntityNotFound,
    check_pages,
    decode_rows,
    find_entity,
    read_export,
    read_lines,
    read_pages,
    reconcile_counts,
    split_valid,
)
from tidemark.sources.pages import created_days

BREAKDOWN = campaign_specs()["breakdown"]


def decode(spark, *lines, spec=BREAKDOWN):
    texts = [(line if isinstance(line, str) else json.dumps(line),) for line in lines]
    return decode_rows(spark.createDataFrame(texts, "value string"), spec)


def faults(spark, *lines, spec=BREAKDOWN):
    return [row["faults"] for row in decode(spark, *lines, spec=spec).collect()]


def test_column_counts_of_all_tables():
    sizes = {spec.name: len(spec.stored.names) for spec in all_specs()}
    assert sizes == {
        "campaigns": 13,
        "campaign_country_daily": 34,
        "campaign_engagement_daily": 28,
        "links": 10,
        "link_country_daily": 26,
        "link_engagement_daily": 27,
        "link_cohort_retention_daily": 37,
        "sync_progress": 7,
        "sync_last": 12,
    }


def test_link_noun_names_tables_columns_and_source_fields():
    specs = link_specs("badge")
    assert specs["breakdown"].name == "badge_country_daily"
    assert "badge_target_isrc" in specs["engagement"].fields.names
    assert specs["entities"].source_name("badge_id") == "badgeId"
    assert "status" not in link_specs()["engagement"].fields.names


def test_good_row_is_typed_and_kept_as_text(spark):
    line = breakdown_line(surprise={"a": [1]})
    row = decode(spark, line).first()
    assert row["faults"] == []
    assert str(row["report_date"]) == "2026-04-01"
    assert (row["streams"], row["cpl"], row["cpf"]) == (520, 0.16, None)
    assert json.loads(row["raw_json"])["surprise"] == {"a": [1]}


def test_counts_may_be_written_as_floats_or_text(spark):
    rows = decode(spark, *[breakdown_line(streams=n) for n in (7, 7.0, "12", None, 1e3)])
    found = rows.select("streams", "faults").collect()
    assert [r["streams"] for r in found] == [7, 7, 12, None, 1000]
    assert all(r["faults"] == [] for r in found)
    assert rows.schema["streams"].dataType.typeName() == "long"


def test_counts_too_large_are_faults_and_large_ones_are_kept(spark):
    most = 2**63 - 1
    found = decode(spark, *[breakdown_line(streams=n) for n in (most, most + 1, 2 * 10**18)]).collect()
    assert [r["streams"] for r in found] == [most, None, 2 * 10**18]
    assert [r["faults"] for r in found] == [[], ["streams: out of range"], []]
    slot = {"playlist_position": 3_000_000_000}
    spec = campaign_specs()["engagement"]
    line = {name: "x" for name in spec.required} | {spec.day: "2026-04-01", "schema_version": "1.0"} | slot
    row = decode(spark, line, spec=spec).first()
    assert row["playlist_position"] is None and "playlist_position: out of range" in row["faults"]


def test_faulty_rows(spark):
    found = faults(
        spark,
        breakdown_line(country_code=None),
        {k: v for k, v in breakdown_line().items() if k != "provider"},
        breakdown_line(report_date="2026-04"),
        breakdown_line(report_date="2026-02-30"),
        breakdown_line(report_date=20260401),
        breakdown_line(campaign_id=5),
        breakdown_line(schema_version=1.0),
        breakdown_line(schema_version=None),
        breakdown_line(streams="many"),
        "not json",
        "[1]",
    )
    assert found == [
        ["country_code: missing"],
        ["provider: missing"],
        ["report_date: not a date"],
        ["report_date: not a date"],
        ["report_date: not a date"],
        ["campaign_id: not text"],
        ["schema_version: not text"],
        [],
        ["undecodable"],
        ["undecodable"],
        ["undecodable"],
    ]


def test_each_table_requires_its_key(spark):
    for specs in (campaign_specs(), link_specs()):
        for role in ("breakdown", "engagement", "retention"):
            if role not in specs:
                continue
            spec = specs[role]
            row = {name: "x" for name in spec.key} | {spec.day: "2026-08-01"}
            assert faults(spark, row, spec=spec) == [[]]
            for name in spec.key:
                lacking = {k: v for k, v in row.items() if k != name}
                assert faults(spark, lacking, spec=spec) == [[f"{name}: missing"]]


def test_split_and_reports(spark):
    rows = decode(
        spark,
        breakdown_line(),
        breakdown_line(schema_version="1.1", country_code="DE"),
        breakdown_line(country_code=None),
    )
    good, aside = split_valid(rows)
    assert (good.count(), aside.count()) == (2, 1)
    assert {tuple(r) for r in version_report(good, BREAKDOWN).collect()} == {("1.1", 1)}
    assert {tuple(r) for r in fault_report(rows).collect()} == {
        ("ok", 2),
        ("country_code: missing", 1),
    }
    assert repeated_keys(good, BREAKDOWN).count() == 0
    assert repeated_keys(good.unionByName(good), BREAKDOWN).count() == 2


def test_blank_lines_are_no_rows_and_order_is_kept(spark, tmp_path):
    lines = [json.dumps(breakdown_line(streams=n)) for n in range(50)]
    (tmp_path / "a.jsonl").write_text("\n\n".join(lines) + "\n   \n")
    rows = read_lines(spark, str(tmp_path))
    assert rows.count() == 50
    ordered = decode_rows(rows, BREAKDOWN).orderBy("file", "block", "line")
    assert [r["streams"] for r in ordered.collect()] == list(range(50))


def test_range_and_ids(spark, tmp_path):
    lines = [
        breakdown_line(report_date=f"2026-04-{day:02d}", campaign_id=name)
        for day in range(1, 11)
        for name in ("a", "b")
    ]
    (tmp_path / "x.jsonl").write_text("\n".join(map(json.dumps, lines)))
    from datetime import date

    ids = spark.createDataFrame([("b",)], "campaign_id string")
    rows = read_export(
        spark, str(tmp_path), BREAKDOWN, date(2026, 4, 3), date(2026, 4, 5), ids
    )
    found = sorted((str(r["report_date"]), r["campaign_id"]) for r in rows.collect())
    assert found == [("2026-04-03", "b"), ("2026-04-04", "b"), ("2026-04-05", "b")]


def test_reconcile_counts(spark):
    rows = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("d",)], "export string")
    manifest = spark.createDataFrame(
        [("a", 3), ("b", 5), ("c", 1), ("e", 0)], "export string, expected int"
    )
    found = {tuple(r) for r in reconcile_counts(rows, manifest).collect()}
    assert found == {("b", 5, 2), ("c", 1, 0)}


def campaign(number, **changes):
    budgets = {"dailyBudget": 12.5, "totalBudget": 500.0, "campaignDuration": 40, "generation": 1}
    times = {"createdAt": "2026-01-15T23:30:00-05:00", "updatedAt": "2026-02-02T02:02:02Z"}
    names = {"campaignId": f"c{number}", "organizationId": "o1", "status": "paused", "socialPlatform": "web"}
    return names | budgets | times | {"unknownField": number} | changes


def write_pages(folder, pages, total):
    folder.mkdir(exist_ok=True)
    for number, items in pages.items():
        pagination = {
            "page": number, "pageSize": 2, "totalCount": total, "totalPages": -(-total // 2),
        }
        body = {"data": {"items": items, "pagination": pagination}, "meta": {"requestId": "r"}}
        (folder / f"{number}.json").write_text(json.dumps(body, indent=2))
    return str(folder)


def test_pages(spark, tmp_path):
    spec = campaign_specs()["entities"]
    path = write_pages(
        tmp_path / "p", {1: [campaign(1), campaign(2)], 2: [campaign(3, strategyType="x")]}, 3
    )
    items = read_pages(spark, path, spec)
    assert check_pages(spark, path).first()["complete"]
    rows = {r["campaign_id"]: r for r in created_days(items).collect()}
    assert sorted(rows) == ["c1", "c2", "c3"]
    assert all(r["faults"] == [] for r in rows.values())
    assert rows["c3"]["strategy_type"] == "x" and rows["c1"]["strategy_type"] is None
    assert json.loads(rows["c2"]["raw_json"])["unknownField"] == 2
    assert str(rows["c1"]["created_date"]) == "2026-01-15"
    assert find_entity(items, "campaign_id", "c2").count() == 1
    with pytest.raises(EntityNotFound, match="c9"):
        find_entity(items, "campaign_id", "c9")


def test_incomplete_and_unreadable_pages(spark, tmp_path):
    path = write_pages(tmp_path / "p", {1: [campaign(1), campaign(2)]}, 3)
    report = check_pages(spark, path).first()
    assert (report["complete"], report["items_found"], report["items_expected"]) == (False, 2, 3)

    broken = write_pages(tmp_path / "q", {1: [campaign(1), campaign(2)], 2: [campaign(3)]}, 3)
    (tmp_path / "q" / "3.json").write_text('{"error": "gone"}')
    assert not check_pages(spark, broken).first()["complete"]
    bad = read_pages(spark, broken, campaign_specs()["entities"]).where(F.size("faults") > 0)
    assert bad.count() == 1


def test_links_listing(spark, tmp_path):
    item = {
        "linkId": "l1", "organizationId": "o", "name": "n", "url": "u", "status": "active",
        "createdAt": "2026-04-01T10:00:00.000Z",
    }
    path = write_pages(tmp_path / "p", {1: [item, {**item, "linkId": None}]}, 2)
    rows = read_pages(spark, path, link_specs()["entities"]).orderBy("position").collect()
    assert rows[0]["faults"] == [] and rows[0]["target_type"] is None
    assert rows[1]["faults"] == ["link_id: missing"]


def test_identities(spark):
    rows = spark.createDataFrame(
        [(60, 42, 18, 89, 58, 31), (61, 42, 18, -1, 0, -1)],
        "listeners bigint, new_listeners bigint, returning_listeners bigint, streams bigint, "
        "new_listener_streams bigint, returning_listener_streams bigint",
    )
    report = identity_report(rows).first()
    assert (report["rows"], report["bad_listeners"], report["bad_streams"]) == (2, 1, 0)
    assert report["negative_streams"] == 1


def test_unit_metrics_match_the_exported_ones(spark):
    row = unit_metrics(decode(spark, breakdown_line()).drop("cpl", "cpf"), "cpl", "cpf").first()
    assert (row["cpl"], row["cpf"]) == (0.16, 4.0)
    empty = decode(spark, breakdown_line(listeners=0)).drop("cpl")
    assert unit_metrics(empty, "cpl").first()["cpl"] is None


def land_in(folder, **line):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.jsonl").write_text(json.dumps(breakdown_line(**line)) + "\n")


def files_opened(rows):
    return {r["file"] for r in rows.select("file").collect()}


def test_a_range_of_days_opens_only_windows_that_can_hold_it(spark, tmp_path):
    for window in ("2025-11-03", "2026-01-10", "2026-03-20", "2026-04-02", "soon"):
        land_in(tmp_path / f"window={window}", report_date="2026-03-25", campaign_id=window)
    start, end = date(2026, 3, 22), date(2026, 3, 31)
    lines = read_lines(spark, str(tmp_path), start, end)
    assert {f.split("window=")[1].split("/")[0] for f in files_opened(lines)} == {"2026-01-10", "2026-03-20", "soon"}
    plan = lines._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PartitionFilters: \[(.*?)\]", plan)[1]
    assert "window" in pushed and "2025-12-23" in pushed
    assert {r["campaign_id"] for r in read_export(spark, str(tmp_path), BREAKDOWN, start, end).collect()} == {
        "2026-01-10", "2026-03-20", "soon",
    }
    # The first and the last window that can hold the first day of the range.
    assert read_lines(spark, str(tmp_path), date(2026, 4, 9), date(2026, 4, 9)).count() == 4
    assert read_lines(spark, str(tmp_path), date(2026, 4, 10), date(2026, 4, 10)).count() == 3
    assert read_lines(spark, str(tmp_path)).count() == 5


def test_entities_asked_for_prune_their_folders_at_run_time(spark, tmp_path):
    for entity in ("007", "7", "8", "a b"):
        land_in(tmp_path / f"entity={entity.replace(' ', '%20')}" / "window=2026-03-20", report_date="2026-03-25", campaign_id=entity)
    ids = spark.createDataFrame([("007", 1), ("a b", 1), ("9", 1), ("8", 0)], "campaign_id string, wanted int")
    lines = read_lines(spark, str(tmp_path), entities=ids.where("wanted = 1").select("campaign_id"))
    assert "dynamicpruning" in lines._jdf.queryExecution().executedPlan().toString()
    assert len(files_opened(lines)) == 2
    found = read_export(spark, str(tmp_path), BREAKDOWN, ids=ids.where("wanted = 1").select("campaign_id"))
    assert {r["campaign_id"] for r in found.collect()} == {"007", "a b"}
    named = read_lines(spark, str(tmp_path), folders=("batch", "entity", "window"))
    assert {(r["batch"], r["entity"]) for r in named.collect()} == {(None, e) for e in ("007", "7", "8", "a b")}


def test_files_outside_folders_are_read_whatever_is_asked(spark, tmp_path):
    land_in(tmp_path, report_date="2026-03-25")
    ids = spark.createDataFrame([("c-1",)], "campaign_id string")
    assert read_lines(spark, str(tmp_path), date(2026, 3, 1), date(2026, 3, 31), ids).count() == 1
