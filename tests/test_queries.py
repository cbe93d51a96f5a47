"""Registered queries against their SQL on the smallest tables, and what their plans may hold."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.lab.registry import registered

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="benchmark tables are not here")

BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_matches_its_sql(spark, sql, name):
    df = contract.queries()[name](spark, str(SF))
    found = canonical([tuple(r) for r in df.collect()], df.columns)
    answer = sql.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert found == canonical(answer.fetchall(), columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in BANNED if word in plan]


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1


def test_one_campaign_reaches_the_scans(spark):
    df = contract.queries()["attributed_share_playlist"](spark, str(SF)).where("campaign_id = 3")
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    # The engagement rows and the stored spend windows; the statement has no campaign.
    assert len(scans) == 3
    assert [line for line in scans if "EqualTo(l_suppkey,3)" in line]
    assert [line for line in scans if "EqualTo(campaign_id,3)" in line]
    assert df.count() > 0
    assert not [line for line in scans if "l_tax" in line]
