"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Months multiply rows after a join, so small inputs still deserve several tasks.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# How landed rows are kept: beside their columns they hold their text, which repeats them.
DENSE = {"compression": "zstd"}


def local_session(app: str = "tidemark", cpus: str | int = "*", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        checkpoint = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = checkpoint.get() if checkpoint.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared scratch folder; nothing is created yet."""
    return os.path.join(scratch_root(spark), "tidemark", f"{name}-{uuid.uuid4().hex}")


@contextmanager
def setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """A session setting that holds for a while."""
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def few_listing_tasks(spark: SparkSession) -> AbstractContextManager[None]:
    """While files are listed: a few tasks a core share the folders.

    By default every folder gets a task, and each task unpacks the whole file system
    configuration, which takes far longer than listing a folder.
    """
    tasks = 4 * spark.sparkContext.defaultParallelism
    return setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", tasks)


def pinned(df: DataFrame, name: str = "pinned") -> DataFrame:
    """Write a reduced result that several branches read, so the facts are scanned once.

    A Parquet table on shared storage: it outlives lost executors, branches read only the
    columns they need, and its size on disk tells Spark whether it may be broadcast.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that is no longer read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """The intermediate tables of one job, deleted together."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def pin(self, df: DataFrame, name: str = "pinned", by: str | None = None) -> DataFrame:
        """``pinned``, remembered for deletion; ``by`` is a column to keep folders apart."""
        return self.pin_all([df], name, by)

    def pin_all(self, parts: Iterable[DataFrame], name: str = "pinned", by: str | None = None) -> DataFrame:
        """Parts of one table, made and written one after the other."""
        path = scratch_dir(self.spark, name)
        self.paths.append(path)
        for df in parts:
            writer = df.write if by is None else df.write.partitionBy(by)
            writer.options(**DENSE).mode("append").parquet(path)
            schema = df.schema
        return self.spark.read.schema(schema).parquet(path)

    def discard(self) -> None:
        while self.paths:
            discard(self.spark, self.paths.pop())

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.discard()
