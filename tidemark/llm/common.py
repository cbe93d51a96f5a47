"""Helpers shared by the operators: tables, fixed row splits and running sums without hot tasks."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows that one task sorts together when a running sum is taken.
RUN_ROWS = 4096


# Texts that go to a Python worker at a time where stages with large models follow each other.
FEW_ROWS = 1000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# What a worker process keeps between tasks, by its owner.
_KEPT: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What this worker process keeps for ``owner``; what it kept for others goes.

    Workers outlive a job, so without that the models of earlier stages would stay in memory
    until the session ends.
    """
    others = [name for name in _KEPT if name != owner]
    for name in others:
        del _KEPT[name]
    if others:
        give_back()
    return _KEPT.setdefault(owner, {})


def give_back() -> None:
    """Return free memory of this worker process to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def few_rows_a_batch(spark: SparkSession, rows: int = FEW_ROWS) -> None:
    """Send at most so many rows at a time to Python workers from now on, in this session."""
    if int(spark.conf.get(BATCH_ROWS)) > rows:
        spark.conf.set(BATCH_ROWS, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def split_of(row_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(row_id).cast("string").cast("binary")) % F.lit(parts)


def is_split(row_id: str, parts: int, part: int) -> Column:
    """Whether a row belongs to the part; rows without an id belong to none."""
    return F.coalesce(split_of(row_id, parts) == F.lit(part), F.lit(False))


def fresh(name: str, taken: list[str]) -> str:
    """A column name that none of ``taken`` has, whatever their case."""
    used = {column.lower() for column in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def running_sum(
    rows: DataFrame,
    by: list[str],
    spread: str,
    order: list[str],
    value: str,
    name: str,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows before this one within ``by``.

    ``spread`` is a double, uniform in [0, 1), and the first thing rows are ordered by; ``order``
    breaks its ties. A key is cut into runs by ``spread``, as many as its rows need, so that no
    task sorts more than some ``run_rows`` rows of a hot key; the sums of the runs are added up
    first and give each run its start. Rows that are equal in every ordering column get places
    in any order.

    ``rows`` is read three times; pass a stored table.
    """
    sizes = rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / F.lit(run_rows)).alias("_runs"))
    cut = F.least(F.floor(F.col(spread) * F.col("_runs")), F.col("_runs") - 1).alias("_run")
    keyed = _same(rows, sizes, by).select(*rows.columns, cut)
    totals = keyed.groupBy(*by, "_run").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*by).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *by, "_run", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start")
    )
    in_run = (
        Window.partitionBy(*by, "_run")
        .orderBy(spread, *order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = keyed.withColumn("_local", F.coalesce(F.sum(value).over(in_run), F.lit(0)))
    placed = _same(local, starts, [*by, "_run"])
    return placed.select(*rows.columns, (F.col("_start") + F.col("_local")).cast("bigint").alias(name))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys where nulls equal nulls; the right keys are dropped."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    same = None
    for key in keys:
        one = F.col(key).eqNullSafe(F.col(f"_r_{key}"))
        same = one if same is None else same & one
    return left.join(renamed, same).drop(*[f"_r_{key}" for key in keys])
