"""Nearest neighbours by a permutation index: pivot orders, inverted files, footrule, rerank."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.vectors import matrix, sample, usable
from tidemark.session import pinned

# Pivots, how many of them a vector is posted under, and vectors sampled to choose them from.
PIVOTS, POSTED, SAMPLE = 128, 40, 4096
# Candidates reranked: so many, and this share of all vectors.
RERANK, RERANK_SHARE = 1000, 0.25
# Vectors of one part of the index, and queries sent to it together.
SHARD_ROWS, QUERY_ROWS = 8192, 8192


def choose_pivots(vectors: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Pivots spread over a sample: each the one least like those before, among some drawn ones."""
    if len(vectors) <= count:
        return vectors
    rng = np.random.default_rng(11)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    chosen = [0]
    closest = unit @ unit[0]
    while len(chosen) < count:
        drawn = rng.choice(len(unit), size=8, replace=False)
        best = int(drawn[np.argmin(closest[drawn])])
        chosen.append(best)
        closest = np.maximum(closest, unit @ unit[best])
    return vectors[chosen]


def pivot_order(vectors: np.ndarray, pivots: np.ndarray, posted: int, largest: float) -> np.ndarray:
    """The nearest pivots of each vector, nearest first.

    Inner products are turned into distances by one further component that gives every vector the
    length of the largest; pivots get it too.
    """
    room = np.sqrt(np.maximum(largest**2 - (vectors**2).sum(axis=1), 0.0))
    other = np.sqrt(np.maximum(largest**2 - (pivots**2).sum(axis=1), 0.0))
    near = vectors @ pivots.T + room[:, None] * other[None, :]
    return np.argsort(-near, axis=1, kind="stable")[:, : min(posted, len(pivots))].astype(np.int16)


def query_order(vectors: np.ndarray, pivots: np.ndarray, posted: int) -> np.ndarray:
    """The same for queries, whose further component is zero."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, : min(posted, len(pivots))].astype(np.int16)


class InvertedFile:
    """Per pivot, the vectors posted under it and its place in their orders."""

    def __init__(self, orders: np.ndarray, pivots: int):
        self.rows, self.posted = orders.shape
        flat = orders.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.row = (by_pivot // self.posted).astype(np.int32)
        self.place = (by_pivot % self.posted).astype(np.int16)
        self.start = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of every posted vector to a query's order.

        A pivot that one side lacks counts as placed after the last. Without a shared pivot the
        distance is the largest, k (k + 1); every shared pivot with places a and b saves
        (k - a) + (k - b) - |a - b|, that is 2 (k - max(a, b)).
        """
        k = self.posted
        saved = np.zeros(self.rows, dtype=np.int16 if k * (k + 1) < 1 << 15 else np.int32)
        for place, pivot in enumerate(order):
            part = slice(self.start[pivot], self.start[pivot + 1])
            saved[self.row[part]] += 2 * (k - np.maximum(self.place[part], place)).astype(saved.dtype)
        return k * (k + 1) - saved


def search(
    rows: DataFrame,
    queries: Column,
    row_id: str = "vec_id",
    vector: str = "embedding",
    nearest: int = 20,
    pivots: int = PIVOTS,
    posted: int = POSTED,
    rerank: int = RERANK,
    rerank_share: float = RERANK_SHARE,
) -> DataFrame:
    """(query_id, rank, id, score): the ``nearest`` largest inner products of every query found.

    Queries are the rows where ``queries`` holds (a column of ``rows``), candidates all rows but
    the query's own. Pivots come from a bounded sample; every vector is indexed by the order of
    its ``posted`` nearest pivots. The index lies in parts by a hash of the id, each with its
    inverted file. A query is sent to every part, in blocks; there all vectors posted under its
    pivots are ranked by the footrule distance of the orders, ties by the least id, and the best
    ``rerank`` plus ``rerank_share`` of all vectors, shared out over the parts, are compared by the
    exact inner product in double precision. A part returns its nearest, and they are merged.

    Equal vectors are one entry of the index, with as many of their least ids as an answer can hold
    (ties go to them), so copies neither crowd others out nor cost a comparison each, and an answer
    does not depend on the order in which rows arrive. Memory is bounded by a part and a block.

    Nearest first, ties to the smaller id; all candidates where there are fewer. Null, zero and
    empty vectors, vectors with null or non-finite components, and rows without an id take no part.
    Repeated rows are candidates of their own, but a row never finds its own id. Other columns
    are ignored. An empty table gives an empty result.
    """
    asked = rows.where(queries).select(F.col(row_id).cast("bigint").alias("id")).distinct()
    shape = "query_id long, ids array<long>, scores array<double>"
    found, size = usable(rows, row_id, vector)
    spark = rows.sparkSession
    stored = pinned(found, "vectors")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    kinds = pinned(_distinct(stored, nearest + 1), "distinct")
    totals = kinds.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("largest")).first()
    if not totals.n:
        empty = spark.createDataFrame([], shape)
        return _ranked(empty, nearest, row_id)
    chosen = choose_pivots(sample(kinds, size, SAMPLE), pivots)
    largest, n = float(totals.largest), totals.n
    shards = -(-n // SHARD_ROWS)
    share = -(-int(rerank + rerank_share * n) // shards)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                orders = pivot_order(matrix(batch.column("vector"), size), chosen, posted, largest)
                listed = pa.FixedSizeListArray.from_arrays(pa.array(orders.ravel(), pa.int16()), orders.shape[1])
                yield batch.append_column("pivots", listed.cast(pa.list_(pa.int16())))

    index = kinds.mapInArrow(indexed, "id long, vector array<double>, ids array<long>, pivots array<short>")
    index = index.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    questions = pinned(stored.join(asked, "id", "left_semi"), "queries")
    groups = max(1, -(-questions.count() // QUERY_ROWS))
    spread = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    posts = index.withColumn("block", spread(groups))
    sent = questions.withColumn("block", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(groups)).cast("int"))
    sent = sent.withColumn("shard", spread(shards))

    def nearest_in(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, scores, names = [], [], []
        if left.num_rows and right.num_rows:
            # In the order of ids, so that a stable sort by distance leaves ties to the least.
            left = left.sort_by("id")
            vectors = matrix(left.column("vector"), size)
            copies = left.column("ids").combine_chunks()
            flat, starts = copies.flatten().to_numpy(), copies.offsets.to_numpy() - copies.offsets[0].as_py()
            orders = left.column("pivots").combine_chunks().flatten().to_numpy().reshape(len(vectors), -1)
            files = InvertedFile(orders, len(chosen))
            asking = matrix(right.column("vector"), size)
            for name, query, order in zip(
                right.column("id").to_pylist(), asking, query_order(asking, chosen, posted)
            ):
                few = np.argsort(files.footrule(order), kind="stable")[:share]
                score = vectors[few] @ query
                # One more than asked for: one may be the query's own.
                least = np.partition(score, -nearest - 1)[-nearest - 1] if len(few) > nearest + 1 else -np.inf
                close = score >= least
                few, score = few[close], score[close]
                sizes = starts[few + 1] - starts[few]
                own = flat[np.repeat(starts[few] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
                each = np.repeat(score, sizes)
                others = own != name
                own, each = own[others], each[others]
                best = np.lexsort((own, -each))[:nearest]
                names.append(name)
                ids.append(own[best])
                scores.append(each[best])
        return pa.table(
            {
                "query_id": pa.array(names, pa.int64()),
                "ids": pa.array(ids, pa.list_(pa.int64())),
                "scores": pa.array(scores, pa.list_(pa.float64())),
            }
        )

    cells = posts.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block"))
    return _ranked(cells.applyInArrow(nearest_in, shape), nearest, row_id)


def _distinct(stored: DataFrame, most: int) -> DataFrame:
    """(id, vector, ids): different vectors with their ``most`` least ids, the first as id.

    Ids are ranked before they are moved, so a vector that very many rows share has a few rows a
    task.
    """
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    firsts = stored.withColumn("rank", rank).where(F.col("rank") <= most)
    ids = F.sort_array(F.collect_list("id")).alias("ids")
    return firsts.groupBy("vector").agg(F.min("id").alias("id"), ids).select("id", "vector", "ids")


def _ranked(cells: DataFrame, nearest: int, row_id: str) -> DataFrame:
    """Merge what the parts found."""
    pairs = F.transform(
        F.arrays_zip("ids", "scores"), lambda p: F.struct((-p["scores"]).alias("far"), p["ids"].alias("id"))
    )
    merged = cells.select("query_id", pairs.alias("p")).groupBy("query_id").agg(
        F.slice(F.sort_array(F.flatten(F.collect_list("p"))), 1, nearest).alias("p")
    )
    placed = merged.select("query_id", F.posexplode("p").alias("place", "p"))
    return placed.select(
        "query_id",
        (F.col("place") + 1).alias("rank"),
        F.col("p.id").alias(row_id),
        (-F.col("p.far")).alias("score"),
    )
