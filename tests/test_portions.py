from __future__ import annotations

from pathlib import Path

import pytest

from tidemark import jobs
from tidemark.lab import ingest, views
from tidemark.schemas import PROGRESS
from tidemark.sources import SnapshotStore
from tidemark.sources.exports import portions


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landed"
    for batch in "ab":
        for entity in range(30):
            folder = root / f"batch={batch}" / "window=2001-07-20" / f"entity={entity}"
            folder.mkdir(parents=True)
            (folder / "a.jsonl").write_text("{}\n" if entity % 2 else "\n")
    (root / "_SUCCESS").write_text("")
    return root


def test_many_folders_are_portioned_and_few_are_not(spark, landing):
    assert portions(spark, str(landing)) == [str(landing)]
    parts = portions(spark, str(landing), 40)
    assert [len(part) for part in parts] == [40, 20]
    names = {path.split("/landed/")[1] for part in parts for path in part}
    assert names == {str(f.relative_to(landing)) for f in landing.glob("batch=*/window=*/entity=*")}
    (landing / "batch=a" / "loose.jsonl").write_text("{}\n")
    assert portions(spark, str(landing), 40) == [str(landing)]


def test_exports_of_portions_are_those_of_the_whole(spark, landing):
    whole = jobs._landed_exports(spark, str(landing)).collect()
    parts = [row for part in portions(spark, str(landing), 40) for row in jobs._landed_exports(spark, part).collect()]
    assert len(whole) == 60 and sorted(whole) == sorted(parts)


@pytest.fixture
def suppliers(spark, tmp_path):
    rows = [(n, f"s{n}", 3, 1.0) for n in range(1, 61)]
    spark.createDataFrame(rows, views.TABLES["supplier"]).coalesce(1).write.parquet(f"{tmp_path}/tables/supplier.parquet")
    return f"{tmp_path}/tables"


@pytest.mark.parametrize("family", ["links", "campaigns"])
def test_a_run_in_portions_ends_as_a_whole_one(spark, suppliers, tmp_path, monkeypatch, family):
    def run(name):
        store = SnapshotStore(spark, f"{tmp_path}/{name}")
        report = ingest._landed_run(spark, suppliers, family, store)
        tables = [report.results, report.outcome, store.read(PROGRESS)]
        return [sorted(map(str, table.collect())) for table in tables], report.finished

    expected = run("whole")
    sizes, cut = [], jobs.portions

    def few(spark, path):
        sizes.append(len(cut(spark, path, 25)))
        return cut(spark, path, 25)

    monkeypatch.setattr(jobs, "portions", few)
    assert run("portions") == expected and max(sizes) > 1


def test_small_landed_files_have_no_checksum_files(spark, suppliers, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "scratch_dir", lambda spark, name: f"{tmp_path}/{name}")
    ingest._landed_run(spark, suppliers, "campaigns", SnapshotStore(spark, f"{tmp_path}/store"))
    folders = [*Path(f"{tmp_path}/landing-campaigns/breakdown").glob("window=*/entity=*")]
    assert len(folders) == 48
    for folder in folders:
        assert [file.name.split("-")[0] for file in folder.iterdir()] == ["part"]
