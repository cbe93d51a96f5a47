from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.lab import ingest, views
from tidemark.operators import quality
from tidemark.schemas import campaign_specs
from tidemark.sources import read_lines
from tidemark.sources.decode import decode_rows

BREAKDOWN = campaign_specs()["breakdown"]
REST = '"provider":"p","account_id":"a","report_date":"2026-04-01","country_code":"DE","schema_version":"1.0"'


@pytest.mark.parametrize(
    ("text", "faults", "campaign"),
    [
        ('{"campaign_id":"7",%s}', [], "7"),
        ('{"campaign_id" : "7", %s}', [], "7"),
        ('{"campaign_id":7,%s}', ["campaign_id: not text"], None),
        ('{"campaign_id" : -7.5e3,%s}', ["campaign_id: not text"], None),
        ('{"campaign_id":true,%s}', ["campaign_id: not text"], None),
        ('{"campaign_id":"true",%s}', [], "true"),
        ('{"campaign_id":["x"],%s}', ["campaign_id: not text"], None),
        ('{"campaign_id":"[x]",%s}', [], "[x]"),
        ('{"campaign_id":{"a":1},%s}', ["campaign_id: not text"], None),
        ('{"campaign_id":{"a":1,"a":2},%s}', ["undecodable"], None),
        ('{"campaign_id":null,%s}', ["campaign_id: missing"], None),
        ('{"campaign_id":"","x":1,%s}', [], ""),
        ('{"campaign_id":"7","campaign_id":8,%s}', ["campaign_id: not text"], None),
        ('{"campaign_id":7,"campaign_id":"8",%s}', [], "8"),
        ('{"note":{"campaign_id":"9"},"campaign_id":8,%s}', ["campaign_id: not text"], None),
        ('{"note":{"campaign_id":9},"campaign_id":"8",%s}', [], "8"),
        ('{"campaign\\u005fid":8,%s}', ["campaign_id: not text"], None),
        ("{'campaign_id':8,\"x\":\"\\\"campaign_id\\\":\",%s}", ["campaign_id: not text"], None),
        ("{'campaign_id':'8',%s}", [], "8"),
        ('{"campaign_id":"7","streams":"many",%s}', ["undecodable"], None),
        ('{"campaign_id":"7","streams":1e30,%s}', ["streams: out of range"], "7"),
    ],
)
def test_a_key_is_judged_by_its_json_type(spark, text, faults, campaign):
    lines = spark.createDataFrame([(text % REST,)], "value string")
    row = decode_rows(lines, BREAKDOWN).first()
    assert row["faults"] == faults
    if faults != ["undecodable"]:
        assert row["campaign_id"] == campaign


@pytest.mark.parametrize("day", ["20260401", "[1]", '{"a":1}', '"2026-4-1"', "true"])
def test_a_day_is_a_text(spark, day):
    text = '{"campaign_id":"7",%s}' % REST.replace('"2026-04-01"', day)
    row = decode_rows(spark.createDataFrame([(text,)], "value string"), BREAKDOWN).first()
    assert row["faults"] == ["report_date: not a date"] and row["report_date"] is None


@pytest.mark.parametrize("name", ["breakdown", "engagement"])
def test_decoding_is_compiled(spark, conf, tmp_path, name):
    """The virtual machine never compiles methods of more than 8,000 bytes."""
    conf(spark__sql__adaptive__enabled="false")
    spark.range(1).select(F.lit("{}")).write.text(f"{tmp_path}/landed")
    decoded = decode_rows(read_lines(spark, f"{tmp_path}/landed"), campaign_specs()[name])
    debug = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.execution.debug.package$")
    stages = debug.getField("MODULE$").get(None).codegenStringSeq(decoded._jdf.queryExecution().executedPlan())
    assert max(stages.apply(n)._3().maxMethodCodeSize() for n in range(stages.size())) <= 8000


def test_faults_are_counted_by_list_first(spark):
    rows = [(["a: missing", "b: missing"],), (["a: missing"],), ([],), ([],)]
    report = quality.fault_report(spark.createDataFrame(rows, "faults array<string>"))
    assert {tuple(r) for r in report.collect()} == {("a: missing", 2), ("b: missing", 1), ("ok", 2)}
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.rindex("Aggregate [faults")


def test_lines_of_the_checked_tables_move_once(spark, tmp_path, monkeypatch):
    row = (1, 1, 1, 2, 1.0, 1.0, 0.0, 0.0, "R", "F", None)
    lines = spark.createDataFrame([row, (*row[:3], 12, *row[4:])], views.TABLES["lineitem"])
    lines.withColumn("l_shipdate", F.lit("1997-03-12").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/lineitem.parquet")
    hints, land = [], ingest.land

    def spy(rows, *args, **options):
        hints.append(options.get("placed"))
        return land(rows, *args, **options)

    monkeypatch.setattr(ingest, "land", spy)
    found = {tuple(r) for r in ingest.key_validation_tables(spark, str(tmp_path)).collect()}
    assert hints == [True] * 7
    expected = {(s.name, f"{s.required[1]}: missing", 1) for s in ingest._checked_specs()}
    assert found == expected | {(s.name, "ok", 1) for s in ingest._checked_specs()}
