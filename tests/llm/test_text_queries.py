"""The registered text queries and the pipeline on the smallest tables."""

from __future__ import annotations

import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import packing
from tidemark.llm.queries import QUERIES
from tidemark.session import pinned

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="benchmark tables are not here")
NATIVE = ("op6_url_rules", "op9_mix")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(n for n, (_, text) in QUERIES.items() if text))
def test_query_matches_its_sql(spark, sql, name):
    df = QUERIES[name][0](spark, str(SF))
    answer = sql.execute(QUERIES[name][1])
    columns = [c[0] for c in answer.description]
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(answer.fetchall(), columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("CartesianProduct", "BroadcastNestedLoopJoin") if w in plan]
    if name in NATIVE:
        assert not [w for w in ("Python", "Arrow", "Pandas") if w in plan]


def test_language_and_toxicity_of_held_out_documents(spark, sql):
    told = QUERIES["op5_language"][0](spark, str(SF)).collect()
    langs = dict(sql.execute("SELECT doc_id, lang FROM documents").fetchall())
    held = [r for r in told if r.held_out]
    assert {r.doc_id for r in held} == {i for i in langs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    scored = QUERIES["op8_toxicity"][0](spark, str(SF)).collect()
    assert {r.doc_id for r in scored if r.held_out} == {i for i in langs if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in scored)


def test_search_finds_the_nearest(spark, sql):
    found = QUERIES["op3_ann"][0](spark, str(SF)).collect()
    rows = sql.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    vectors = np.array([v for _, v in rows], dtype=float)
    hits = 0
    queries = [i for i, _ in rows if i % 20 == 0]
    for i in queries:
        scores = vectors @ vectors[i]
        scores[i] = -np.inf
        best = set(np.argsort(-scores, kind="stable")[:20].tolist())
        hits += len(best & {r.vec_id for r in found if r.query_id == i})
    assert hits >= 0.9 * 20 * len(queries)


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage was given and what it returned."""
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = pinned(stage(spark, docs, str(SF)), name)
        seen[name] = (docs, out)
        docs = out
    return seen


def test_every_stage_keeps_the_columns_of_documents(stages):
    for name, (given, kept) in stages.items():
        if name != "packing":
            assert kept.columns == given.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_filters_keep_rows_as_they_are(spark, stages):
    for name in ("toxicity", "language", "near_duplicates"):
        given, kept = stages[name]
        assert kept.exceptAll(given).count() == 0
    scored = QUERIES["op8_toxicity"][0](spark, str(SF)).where("predicted = 0")
    assert {r.doc_id for r in stages["toxicity"][1].collect()} == {r.doc_id for r in scored.collect()}


def test_one_document_of_each_group_stays(spark, stages):
    given, kept = stages["near_duplicates"]
    from tidemark.llm import simhash

    groups = simhash.near_duplicates(given).collect()
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in groups})


def test_sources_come_near_their_targets(spark, stages):
    from tidemark.llm import mixing

    given, kept = stages["mixing"]
    count = mixing.word_count(F.col("text")).alias("w")
    words = {r.source: r.n for r in kept.select("source", count).groupBy("source").agg(F.sum("w").alias("n")).collect()}
    sized = given.select("source", count.alias("size"))
    longest = {r.source: r.n for r in sized.groupBy("source").agg(F.max("size").alias("n")).collect()}
    for r in mixing.source_targets(sized).collect():
        assert abs(words.get(r.source, 0) - r.target) <= longest[r.source] / 2 + 1
    assert max(Counter(r.doc_id for r in kept.collect()).values()) <= 2


def test_packing_holds_every_document(stages):
    given, kept = stages["packing"]
    ids = packing.WordIds(packing.tokenizer_path())
    want = Counter()
    for r in given.collect():
        data = ids(r.text or "") + b"\x01\0\0\0"
        for piece, at in enumerate(range(0, len(data), 16_384)):
            want[r.doc_id, piece, zlib.crc32(data[at : at + 16_384])] += 1
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in kept.collect()) == want


def test_run_is_its_stages(spark, stages):
    whole = corpus_pipeline.run(spark, str(SF))
    assert whole.columns == stages["packing"][1].columns
    assert whole.select("doc_id", "piece").exceptAll(stages["packing"][1].select("doc_id", "piece")).count() == 0
