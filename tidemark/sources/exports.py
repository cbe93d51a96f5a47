"""Newline-delimited metric exports."""

from __future__ import annotations

from contextlib import AbstractContextManager
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.windows import MAX_DAYS
from tidemark.schemas import TableSpec
from tidemark.session import few_listing_tasks, setting
from tidemark.sources.decode import decode_rows

# The folders a fetcher may sort exports into, name=value each.
BATCH, ENTITY, WINDOW = "batch", "entity", "window"
FOLDERS = (BATCH, ENTITY, WINDOW)
# Folders whose files are listed at once: the driver holds some kilobytes for each.
PORTION = 20_000


def _folders_as_text(spark: SparkSession) -> AbstractContextManager[None]:
    """Folder values stay what they are: an entity 007 is not the number 7."""
    return setting(spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false")


def window_reaches(first: date | None, last: date | None, days: int = MAX_DAYS) -> Column:
    """Whether an export whose window starts on the folder's day can hold days of the range.

    A window has at most ``days`` days. Folders that name no day are always read. The text of a
    day sorts like the day, so the filter is one on the folder alone.
    """
    window = F.col(WINDOW)
    reaches = F.lit(True)
    if first is not None:
        reaches = reaches & (window >= F.lit(str(first - timedelta(days=days - 1))))
    if last is not None:
        reaches = reaches & (window <= F.lit(str(last)))
    return reaches | ~window.rlike(r"^\d{4}-\d\d-\d\d$")


def portions(spark: SparkSession, path: str, size: int = PORTION) -> list[str | list[str]]:
    """A landing of exports as lists of at most ``size`` of its folders, or whole if it has no more.

    Levels of name=value folders are gone down while they have few folders. Where something else
    lies beside such folders, the landing stays whole.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    below = ""
    while True:
        folders = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}{below}/*=*"))
        every = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}{below}/[^._]*"))
        if not folders or len(folders) != len(every) or size // 20 < len(folders) <= size:
            return [path]
        if len(folders) > size:
            # One text for all: a call for each name would take longer than to list it.
            names = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.Object, len(folders))
            paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(folders)
            spark._jvm.java.lang.System.arraycopy(paths, 0, names, 0, len(folders))
            found = spark._jvm.org.apache.commons.lang3.StringUtils.join(names, "\n")
            folders = found.split("\n")
            return [folders[n : n + size] for n in range(0, len(folders), size)]
        below += "/*=*"


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    start: date | None = None,
    end: date | None = None,
    entities: DataFrame | None = None,
    folders: tuple[str, ...] = (),
) -> DataFrame:
    """Non-blank lines with where they came from.

    (file, block, line) orders the lines of a file as written: ``block`` is the start of the
    input split and ``line`` grows within it.

    Where exports lie in folders, those that cannot hold what is asked for are never opened: a
    range of days is a filter on ``window=YYYY-MM-DD``, and ``entities`` (one column of ids) meet
    ``entity=`` in a semi-join that prunes folders when the query runs. ``folders`` names those
    whose values are columns of the result, null where a layout lacks one.
    """
    with _folders_as_text(spark), few_listing_tasks(spark):
        landed = spark.read.text(path)
    if WINDOW in landed.columns:
        landed = landed.where(window_reaches(start, end))
    found = [name for name in FOLDERS if name in landed.columns]
    lines = landed.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        *found,
    )
    if entities is not None and ENTITY in found:
        asked = entities.select(F.col(entities.columns[0]).cast("string").alias(ENTITY))
        lines = lines.join(asked.distinct(), ENTITY, "left_semi")
    values = [F.col(n) if n in found else F.lit(None).cast("string").alias(n) for n in folders]
    lines = lines.where(F.trim("value") != "")
    return lines.select("value", "file", "block", F.monotonically_increasing_id().alias("line"), *values)


def between_days(
    rows: DataFrame, spec: TableSpec, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Rows whose day lies in the inclusive range; an open end does not filter."""
    if start is not None:
        rows = rows.where(F.col(spec.day) >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col(spec.day) <= F.lit(end))
    return rows


def only_ids(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of the listed entities.

    No hint: Spark broadcasts the ids when their size allows it and shuffles otherwise, where
    adaptive execution splits an entity that holds a large part of the rows.
    """
    return rows.join(ids.select(column).distinct(), column, "left_semi")


def read_export(
    spark: SparkSession,
    path: str | list[str],
    spec: TableSpec,
    start: date | None = None,
    end: date | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Decoded rows of landed exports, optionally for a day range and a set of entities.

    Folders that cannot hold them are not opened (see ``read_lines``); days and ids are then
    checked on the rows.
    """
    if ids is None:
        return between_days(decode_rows(read_lines(spark, path, start, end), spec), spec, start, end)
    noun_id = next(name for name in spec.key if name in ids.columns)
    lines = read_lines(spark, path, start, end, ids.select(noun_id))
    return only_ids(between_days(decode_rows(lines, spec), spec, start, end), ids, noun_id)


def reconcile_counts(rows: DataFrame, manifest: DataFrame, by: str = "export") -> DataFrame:
    """Exports whose declared row count differs from the rows found; empty when all agree.

    ``manifest`` has (``by``, expected). An export without a manifest line has no declared
    count and is not a mismatch; a declared export without any rows is.
    """
    found = rows.groupBy(by).agg(F.count(F.lit(1)).alias("found"))
    both = manifest.join(found, by, "full_outer")
    return both.select(by, "expected", F.coalesce("found", F.lit(0)).alias("found")).where(
        F.col("expected").isNotNull() & (F.col("expected") != F.col("found"))
    )


def rejected_exports(decoded: DataFrame, by: str = "export") -> DataFrame:
    """Exports holding at least one bad row, with the number of bad rows."""
    bad = F.count_if(F.size("faults") > 0)
    return decoded.groupBy(by).agg(bad.alias("bad_rows")).where(F.col("bad_rows") > 0)
