"""Keyed replacement of rows: newest row per key, and the upsert of a batch into a stored table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.schemas import TableSpec
from tidemark.sources.snapshots import SnapshotStore, evolve, with_period

LINE_ORDER = ("file", "block", "line")
# Rows of a period are spread over cells of about this size on disk, a file each.
CELL_BYTES, ROW_BYTES = 32 << 20, 100
# A task sorts about so much of that: whole rows with their text are many times larger in memory.
TASK_BYTES = 16 << 20
# Copies of one key that a task may meet; keys with more are reduced before they move. Such a key
# is found as one of the most frequent of its period, kept track of in a sketch of fixed size.
HOT_COPIES, HOT_KEYS, TRACKED = 100_000, 16, 4096


def latest_by_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in the given order; the other columns break ties.

    The rank is cut at one in every task before the shuffle, so copies of a key shrink to one row
    a task and a key repeated over a third of the batch is no hot spot.
    """
    last = Window.partitionBy(*key).orderBy(*_newest_first(rows, key, order))
    return _first(rows, last)


def _first(rows: DataFrame, window) -> DataFrame:
    return rows.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")


def _newest_first(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> list[Column]:
    """The order, then all other columns that can be ordered."""
    unordered = {f.name for f in rows.schema if f.dataType.typeName() in ("map", "variant")}
    others = [name for name in rows.columns if name not in {*key, *order, *unordered}]
    return [F.col(name).desc_nulls_last() for name in (*order, *others)]


@dataclass(frozen=True)
class WriteReport:
    """Rows given to an upsert, keys they had, and rows of the touched periods afterwards.

    The last two are observed by the job that writes; nothing is counted again.
    """

    given: int
    kept: int
    stored: int

    @property
    def repeated(self) -> int:
        """Rows replaced by a later row of the same batch."""
        return self.given - self.kept


def upsert(
    store: SnapshotStore,
    spec: TableSpec,
    batch: DataFrame,
    synced_at: datetime,
    order: Sequence[str] = LINE_ORDER,
    once: tuple[str, int] | None = None,
) -> int:
    """``write_batch``, for callers that only want the number of rows given."""
    return write_batch(store, spec, batch, synced_at, order, once).given


def write_batch(
    store: SnapshotStore,
    spec: TableSpec,
    batch: DataFrame,
    synced_at: datetime,
    order: Sequence[str] = LINE_ORDER,
    once: tuple[str, int] | None = None,
) -> WriteReport:
    """Put the last row per key of a batch into a stored table.

    All columns of a replaced row are replaced, nulls too; other rows stay. ``batch`` must give
    the same rows each time it is read: a narrow pass over keys and days finds the periods it
    touches, then it meets the stored rows of those periods. Both are shuffled once, by period and
    a hash of the key, into the files they are written to; there one sort by key brings the
    newest row of a key to the front and leaves rows in the order files want.

    ``once`` names a source of numbered batches and this batch's number: a number that is not above
    the last one published for the source changes nothing.
    """
    base = store.version(spec)
    if once is not None and store.last_batch(spec, once[0], base) >= once[1]:
        return WriteReport(0, 0, 0)
    columns = store.columns(spec)
    stamped = batch.withColumn("synced_at", F.lit(synced_at).cast("timestamp"))
    by = [name for name in order if name in batch.columns]
    given = evolve(with_period(stamped, spec), columns, ("period", *[c for c in by if c not in columns.names]))
    touched = _touched(given, spec.key)
    if any(row["period"] is None for row in touched):
        raise ValueError(f"{spec.name}: rows without {spec.day}")
    rows = sum(row["given"] for row in touched)
    if not rows:
        return WriteReport(0, 0, 0)

    periods = {row["period"]: row["given"] for row in touched}
    hot = [item["item"] for row in touched for item in row["often"] if item["count"] >= HOT_COPIES]
    stored = store.read(spec, periods, with_period=True, version=base)
    every = stored.withColumn("_new", F.lit(0)).unionByName(
        _few_copies(given, spec.key, by, hot).withColumn("_new", F.lit(1)), allowMissingColumns=True
    )
    sizes = _sizes(store, spec, periods, base)
    merged = _merged(every, spec, by, _cells(sizes), _tasks(store.spark, sizes))
    seen = Observation()
    written = merged.observe(
        seen, F.count_if(F.col("_new") == 1).alias("kept"), F.count(F.lit(1)).alias("stored")
    )
    store.write_periods(spec, written, base, arranged=True, only=set(periods), once=once)
    return WriteReport(rows, **seen.get)


def _touched(given: DataFrame, key: Sequence[str]) -> list[Row]:
    """Per period the rows given and the hashes of its most frequent keys, in one narrow pass."""
    often = F.call_function("approx_top_k", F.xxhash64(*key), F.lit(HOT_KEYS), F.lit(TRACKED))
    return given.groupBy("period").agg(F.count(F.lit(1)).alias("given"), often.alias("often")).collect()


def _few_copies(given: DataFrame, key: Sequence[str], order: Sequence[str], hot: list[int]) -> DataFrame:
    """The batch with very frequent keys reduced to their last row; ``hot`` holds their hashes."""
    if not hot:
        return given
    frequent = F.xxhash64(*key).isin(hot)
    return given.where(~frequent).unionByName(latest_by_key(given.where(frequent), key, order))


def _sizes(store: SnapshotStore, spec: TableSpec, periods: dict[int, int], version: int) -> dict[int, int]:
    """About the bytes that each period takes on disk, stored and given."""
    stored = store.sizes(spec, periods, version)
    return {p: stored.get(p, 0) + given * ROW_BYTES for p, given in periods.items()}


def _cells(sizes: dict[int, int]) -> dict[int, int]:
    """Cells per period, by its size; those of one cell are left out."""
    cells = {period: 1 + size // CELL_BYTES for period, size in sizes.items()}
    return {period: count for period, count in cells.items() if count > 1}


def _tasks(spark: SparkSession, sizes: dict[int, int]) -> int | None:
    """Tasks that sort the rows in memory; none where the session's own number is enough."""
    wanted = 1 + sum(sizes.values()) // TASK_BYTES
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def _merged(
    every: DataFrame, spec: TableSpec, order: Sequence[str], cells: dict[int, int], tasks: int | None = None
) -> DataFrame:
    """The newest row per key, each period's rows together in its cells and ordered by key.

    The window's partitioning holds that of the shuffle before it, so no second shuffle follows.
    """
    cell = F.lit(0)
    if cells:
        count = F.element_at(F.create_map(*[F.lit(x) for pair in cells.items() for x in pair]), F.col("period"))
        cell = F.when(count.isNotNull(), F.pmod(F.xxhash64(*spec.key), count)).otherwise(0)
    where = ("period", "_cell") if tasks is None else (tasks, "period", "_cell")
    placed = every.withColumn("_cell", cell.cast("int")).repartition(*where)
    by_entity = sorted(spec.key, key=lambda name: not name.endswith("_id"))
    newest = _newest_first(every.drop("period", "_new"), spec.key, order)
    window = Window.partitionBy("period", "_cell", *by_entity).orderBy(F.desc("_new"), *newest)
    return _first(placed, window)
