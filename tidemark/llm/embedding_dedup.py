"""Near-duplicate vectors by iterative quantisation, multi-index Hamming tables and a rerank."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.vectors import is_usable, matrix, sample
from tidemark.session import pinned

COSINE = 0.9
# Vectors the rotations are learned from, steps of learning, and bits of one code at most.
SAMPLE, STEPS, CODE_BITS = 4096, 30, 64
# Rows a bucket of a table should hold, the bits a key may always have, and the chance to miss a link
# at the threshold itself; links above it are missed far less often.
BUCKET, LEAST_BITS, MISS = 200, 8, 0.01
# Rows compared with each other in one piece.
BLOCK = 512
# Pairs at the threshold that the number of tables is tried on, at least.
TRIALS = 4096


@dataclass(frozen=True)
class Tables:
    """How vectors are coded: ``codes`` of (centre, projection); keys of ``bits`` bits each."""

    codes: tuple[tuple[np.ndarray, np.ndarray], ...]
    bits: int
    count: int

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """The key of every unit vector in every table; without bits there is one table of one key."""
        if not self.bits:
            return np.zeros((len(unit), 1), dtype=np.int64)
        parts = []
        for centre, projection in self.codes:
            signs = (unit - centre) @ projection > 0
            whole = signs.shape[1] // self.bits * self.bits
            parts.append(signs[:, :whole].reshape(len(unit), -1, self.bits))
        found = np.concatenate(parts, axis=1)[:, : self.count]
        return found @ (1 << np.arange(self.bits, dtype=np.int64))


def iterative_quantisation(unit: np.ndarray, bits: int, seed: int, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(centre, projection) whose signs are balanced binary codes.

    The vectors are projected on their main directions; then a rotation and the nearest corners of
    the cube are fitted to each other in turn, which evens out what the bits carry.
    """
    centre = unit.mean(axis=0)
    _, main = np.linalg.eigh((unit - centre).T @ (unit - centre))
    directions = main[:, ::-1][:, :bits]
    flat = (unit - centre) @ directions
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))[0]
    for _ in range(steps):
        corners = np.where(flat @ rotation > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(corners.T @ flat)
        rotation = right.T @ left.T
    return centre, directions @ rotation


def partners(unit: np.ndarray, cosine: float, seed: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """Unit vectors and others at the given cosine to them: away from them in a random direction,
    and in that of another vector of the sample."""
    rng = np.random.default_rng(seed)
    ones = np.tile(unit, (-(-TRIALS // len(unit)), 1))
    loose = rng.standard_normal(ones.shape)
    found = []
    for way in (loose, ones[rng.permutation(len(ones))] - unit.mean(axis=0)):
        away = way - (way * ones).sum(axis=1, keepdims=True) * ones
        length = np.linalg.norm(away, axis=1, keepdims=True)
        fine = length[:, 0] > 1e-6
        if fine.any():
            found.append((ones[fine], cosine * ones[fine] + math.sqrt(1 - cosine**2) * away[fine] / length[fine]))
    return found


def _met(code: tuple[np.ndarray, np.ndarray], bits: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """For each kind of pair: which pairs meet in which table of a code."""
    every = Tables((code,), bits, code[1].shape[1] // bits)
    return [every.keys(one) == every.keys(other) for one, other in pairs]


def learn_tables(vectors: np.ndarray, rows: int, cosine: float = COSINE) -> Tables:
    """Tables for ``rows`` vectors, learned from a sample.

    How often two vectors at the threshold meet in a table depends on where the vectors lie, most
    of all on a direction they have in common, so it is tried: the vectors of the sample get
    partners at the threshold, and tables are added, from as many codes as have that many separate
    keys, until no more than MISS / 2 of the partners of either kind are missed: half of MISS is
    left for vectors that were not in the sample.

    A key has as many bits as keep buckets near BUCKET rows, so work grows little faster than the
    rows. It has fewer where so many tables would be needed that larger buckets are less work, and
    none, so that all vectors are compared, where no keys of any length find the partners.
    """
    size = vectors.shape[1]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    most = min(size, max(LEAST_BITS, round(math.log2(max(2, rows / BUCKET)))))
    width = min(size, CODE_BITS)
    pairs = partners(unit, cosine)
    codes = [iterative_quantisation(unit, width, 0)]

    def tables_of(bits: int) -> int:
        agree = min((float(m.mean()) for m in _met(codes[0], bits, pairs)), default=1.0)
        return 1 if agree >= 1 else math.ceil(math.log(MISS) / math.log1p(-agree)) if agree > 0 else rows

    wanted = {bits: tables_of(bits) for bits in range(1, most + 1)}
    order = sorted(wanted, key=lambda bits: (wanted[bits] * (BUCKET + rows / 2**bits), -bits))
    for bits in range(order[0], 0, -1):
        if wanted[bits] * (BUCKET + rows / 2**bits) > 2 * (BUCKET + rows):
            continue
        missed = [np.ones(len(one), dtype=bool) for one, _ in pairs]
        count = 0
        # Tables of one sample are alike to some degree: allow for twice as many as independent ones.
        for place in range(2 * math.ceil(wanted[bits] / (width // bits)) + 1):
            if place == len(codes):
                codes.append(iterative_quantisation(unit, width, place))
            met = _met(codes[place], bits, pairs)
            for table in range(width // bits):
                count += 1
                missed = [m & ~found[:, table] for m, found in zip(missed, met)]
                if all(m.mean() <= MISS / 2 for m in missed):
                    return Tables(tuple(codes[: place + 1]), bits, count)
    return Tables((codes[0],), 0, 1)


def _unit(column: pa.ChunkedArray, size: int) -> np.ndarray:
    found = matrix(column, size)
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def _local_roots(linked: np.ndarray) -> np.ndarray:
    """The least place each place is connected to, given who is linked to whom."""
    roots = np.arange(len(linked))
    while True:
        least = np.where(linked, roots[None, :], len(roots)).min(axis=1)
        least = np.minimum(roots, least)
        least = least[least]
        if (least == roots).all():
            return roots
        roots = least


def _cells(rows: DataFrame, by: list[str], block: int, spread: Column) -> DataFrame:
    """Rows dealt to pairs of blocks (one, two) of their group, so that any two rows of a group
    meet, and no piece holds more than two blocks."""
    sizes = rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    dealt = rows.join(sizes, by).withColumn("own", F.pmod(spread, F.col("blocks")).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # A group of several blocks needs no piece for one block: its rows meet beside another block.
    return paired.select(
        "*", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two")
    )


def found_links(rows: DataFrame, size: int, tables: Tables, cosine: float = COSINE) -> DataFrame:
    """Pairs (a, b) that connect all rows (row, vector) found within the threshold.

    Rows meet in a bucket of a table, are compared by the exact cosine, and each is linked to the
    least row it is connected to there: rows out stay in proportion to rows in.
    """

    def keyed(batches):
        for batch in batches:
            if batch.num_rows:
                keys = tables.keys(_unit(batch.column("vector"), size))
                listed = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel(), pa.int64()), keys.shape[1])
                yield batch.append_column("keys", listed.cast(pa.list_(pa.int64())))

    def link(piece: pa.Table) -> pa.Table:
        names = piece.column("row").to_numpy()
        order = np.argsort(names, kind="stable")
        names = names[order]
        unit = _unit(piece.column("vector"), size)[order]
        linked = unit @ unit.T >= cosine
        roots = _local_roots(linked) if linked.sum() > len(names) else np.arange(len(names))
        moved = np.flatnonzero(roots != np.arange(len(names)))
        return pa.table({"a": names[roots[moved]], "b": names[moved]})

    coded = rows.select("row", "vector").mapInArrow(keyed, "row long, vector array<double>, keys array<long>")
    posted = coded.select("row", "vector", F.posexplode("keys").alias("table", "key"))
    # Only buckets with company are of use; keys are counted before vectors move.
    cells = _cells(posted, ["table", "key"], BLOCK, F.xxhash64("row"))
    kept = cells.where((F.col("one") < F.col("two")) | (F.col("blocks") == 1))
    pieces = kept.select("table", "key", "one", "two", "row", "vector").groupBy("table", "key", "one", "two")
    return pieces.applyInArrow(link, "a long, b long")


def count_links(members: DataFrame, size: int, cosine: float = COSINE) -> DataFrame:
    """(row, links): for rows (row, root, copies, vector), the copies linked within each root.

    All rows of a component are compared, block by block, so links that no table found count too.
    Components of less than a block share pieces.
    """

    def count(piece: pa.Table) -> pa.Table:
        names, roots = piece.column("row").to_numpy(), piece.column("root").to_numpy()
        own, copies = piece.column("own").to_numpy(), piece.column("copies").to_numpy()
        one, two = piece.column("one")[0].as_py(), piece.column("two")[0].as_py()
        unit = _unit(piece.column("vector"), size)
        linked = (unit @ unit.T >= cosine) & (roots[:, None] == roots[None, :])
        linked &= names[:, None] != names[None, :]
        if one != two:
            linked &= own[:, None] != own[None, :]
        return pa.table({"row": names, "links": linked @ copies})

    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    shares = F.ceil(F.sum(F.when(F.col("n") < BLOCK, F.col("n")).otherwise(0)) / F.lit(BLOCK / 2))
    pieces = max(1, sizes.agg(shares.alias("s")).first().s or 1)
    small = F.pmod(F.xxhash64("root", F.lit(3)), F.lit(pieces))
    grouped = members.join(sizes, "root").withColumn("part", F.when(F.col("n") < BLOCK, small).otherwise(F.lit(-1)))
    grouped = grouped.withColumn("whole", F.when(F.col("n") < BLOCK, F.lit(None).cast("long")).otherwise(F.col("root")))
    grouped = grouped.withColumn("group", F.coalesce("whole", F.col("part")))
    keyed = grouped.withColumn("large", F.col("n") >= BLOCK)
    cells = _cells(keyed, ["large", "group"], BLOCK, F.xxhash64("row"))
    dealt = cells.select("large", "group", "one", "two", "own", "row", "root", "copies", "vector")
    counted = dealt.groupBy("large", "group", "one", "two").applyInArrow(count, "row long, links long")
    return counted.groupBy("row").agg(F.sum("links").alias("links"))


def near_duplicates(
    rows: DataFrame, row_id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """(row_id, n_links, component_id, kept) for every row of ``rows``.

    Two vectors are linked at a cosine of ``cosine`` or more, in double precision. Equal vectors
    are one node with a number of copies. Candidates come from tables of binary codes (learned
    from a bounded sample) and are compared by their original vectors; connected ones form a
    component, and within it all vectors are compared, so the links of a row are those it has in
    its component. ``component_id`` is the least id of the component, and the row with that id is
    ``kept``.

    Null, zero and empty vectors, vectors with null or non-finite components or of another length
    than most, and rows without an id link with nothing and are kept. Rows that repeat an id are
    vectors of their own. Other columns are ignored. An empty table gives an empty result.
    """
    every = pinned(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(row_id).cast("bigint").alias("id"),
            F.when(F.col(row_id).isNotNull() & is_usable(F.col(vector)), F.col(vector).cast("array<double>")).alias("vector"),
        ),
        "rows",
    )
    lengths = every.where("vector is not null").groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), "d").limit(1).collect()
    size = most[0].d if most else 0
    fine = every.where(F.col("vector").isNotNull() & (F.size("vector") == size))
    nodes = pinned(
        fine.groupBy("vector").agg(F.min("row").alias("row"), F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies")),
        "nodes",
    )
    count = nodes.count()
    if not count:
        return _alone(every, row_id)
    tables = learn_tables(sample(nodes.withColumn("id", F.col("row")), size, SAMPLE), count, cosine)
    roots = pinned(components(found_links(nodes, size, tables, cosine)), "roots")
    members = nodes.join(roots, F.col("row") == F.col("node")).select("row", "root", "copies", "vector")
    links = count_links(pinned(members, "members"), size, cosine)
    named = nodes.join(roots, F.col("row") == F.col("node"), "left").join(links, "row", "left").select(
        "row",
        "first_id",
        "copies",
        F.coalesce("root", "row").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"),
    )
    named = pinned(named, "named")
    firsts = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = named.join(firsts, "root").select("row", "n_links", "component_id", "copies")
    repeated = nodes.where("copies > 1").select(F.col("vector").alias("same"), F.col("row").alias("node"))
    copied = fine.select("row", "vector").join(repeated, F.col("vector") == F.col("same")).select("row", "node")
    copies = copied.where("row != node").join(known.withColumnRenamed("row", "node"), "node").select(
        "row", "n_links", "component_id"
    )
    linked = known.select("row", "n_links", "component_id").unionByName(copies)
    return _shaped(every.select("row", "id").join(linked, "row", "left"), row_id)


def _alone(every: DataFrame, row_id: str) -> DataFrame:
    none = F.lit(None).cast("bigint")
    return _shaped(every.select("row", "id").withColumn("n_links", none).withColumn("component_id", none), row_id)


def _shaped(rows: DataFrame, row_id: str) -> DataFrame:
    component = F.coalesce("component_id", "id")
    return rows.select(
        F.col("id").alias(row_id),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
