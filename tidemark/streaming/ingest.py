"""Structured Streaming ingest: dropped exports are decoded, judged and upserted."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.upsert import upsert
from tidemark.plans.windows import LOOKBACK_DAYS, lookback_range
from tidemark.schemas import TableSpec
from tidemark.session import DENSE, discard, scratch_dir
from tidemark.sources.decode import decode_rows
from tidemark.sources.snapshots import SnapshotStore


def on_time(day: Column, as_of: date, days: int = LOOKBACK_DAYS) -> Column:
    """True for days the lookback still re-reads; a missing day is not on time."""
    start, _ = lookback_range(as_of, days)
    return F.coalesce(day >= F.lit(start), F.lit(False))


def late_split(
    rows: DataFrame, day: str, as_of: date, days: int = LOOKBACK_DAYS
) -> tuple[DataFrame, DataFrame]:
    """(rows to upsert, rows older than the lookback)."""
    fresh = on_time(F.col(day), as_of, days)
    return rows.where(fresh), rows.where(~fresh)


def stream_exports(
    spark: SparkSession,
    path: str,
    store: SnapshotStore,
    spec: TableSpec,
    checkpoint: str,
    clock: Callable[[], datetime],
    days: int = LOOKBACK_DAYS,
    max_files: int = 1000,
) -> StreamingQuery:
    """Upsert all files dropped below ``path`` since the last run, then stop.

    Rows replace stored rows, so nothing is summed in state. The table's snapshot records the
    micro-batch it holds, so a replay of it changes nothing. Each micro-batch is parsed once into
    a staged table. Faulty and late rows stay below ``<root>/<table>/aside/<checkpoint name>``, a
    folder per micro-batch that a replay overwrites.
    """
    lines = (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", max_files)
        .load(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_modification_time").alias("landed"),
            F.col("_metadata.file_block_start").alias("block"),
        )
        .where(F.trim("value") != "")
    )
    name = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def load(batch: DataFrame, batch_id: int) -> None:
        # The clock is read once per batch: a replay after midnight must keep the same rows.
        told = store.note(spec.name, "clock", name, batch_id, text=clock().isoformat())
        now = datetime.fromisoformat(told)
        numbered = batch.withColumn("line", F.monotonically_increasing_id())
        fresh = on_time(F.col(spec.day), now.date(), days) if spec.day else F.lit(True)
        reason = F.when(F.size("faults") > 0, "faulty").when(~fresh, "late")
        staging = scratch_dir(spark, "micro-batch")
        decode_rows(numbered, spec).withColumn("reason", reason).write.options(**DENSE).parquet(staging)
        judged = spark.read.parquet(staging)
        aside = judged.where(F.col("reason").isNotNull())
        folder = f"{store.root}/{spec.name}/aside/{name}/batch={batch_id}"
        aside.write.mode("overwrite").options(**DENSE).parquet(folder)
        accepted = judged.where(F.col("reason").isNull()).drop("faults", "reason")
        order = ("landed", "file", "block", "line")
        upsert(store, spec, accepted, now, order, once=(name, batch_id))
        discard(spark, staging)

    writer = lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
