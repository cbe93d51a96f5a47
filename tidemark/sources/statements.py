"""Distributor statements landed as CSV."""

from __future__ import annotations

import csv
import io
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import statement_month
from tidemark.schemas import STATEMENT_FIELDS

# Fixed value: the statement's name of the store the analyses use.
STORE = "Spotify"


# Bytes of a file that its header line must fit in.
HEADER_BYTES = 1 << 16


def read_statement(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Statement lines with declared types, whatever the order of a file's columns.

    Columns are found by the names in each file's header; others are ignored and a missing one is
    an error, as is a number that cannot be read. A header is the first line of the first bytes
    of a file, so no more than those are read to find it, and files with the same header are read
    together. Types are declared: inference would read YYYY-MM as a timestamp.
    """
    # Opened by the tasks: 64 KB a file, however long it is.
    starts = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = [row["path"] for row in starts.where(F.col("length") > 0).select("path").collect()]
    if not files:
        return spark.createDataFrame([], STATEMENT_FIELDS)
    headers = _headers(spark, files)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file, names in headers.items():
        by_header.setdefault(names, []).append(file)
    parts = [_read_alike(spark, names, alike) for names, alike in sorted(by_header.items())]
    return reduce(DataFrame.unionByName, parts)


def _headers(spark: SparkSession, files: list[str]) -> dict[str, tuple[str, ...]]:
    """Column names of every file, read by the file system from its first bytes."""
    conf = spark._jsc.hadoopConfiguration()
    found = {}
    for file in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        stream = path.getFileSystem(conf).open(path)
        try:
            start = bytes(stream.readNBytes(HEADER_BYTES)).decode("utf-8-sig", "replace")
        finally:
            stream.close()
        names = next(csv.reader(io.StringIO(start.splitlines()[0])), [])
        found[file] = tuple(name.strip() for name in names)
    return found


def _read_alike(spark: SparkSession, names: tuple[str, ...], files: list[str]) -> DataFrame:
    """The declared columns of files that share a header."""
    absent = [field.name for field in STATEMENT_FIELDS if field.name not in names]
    if absent:
        raise ValueError(f"statement without {', '.join(absent)}: {files[:3]}")
    # The first of two columns with one name counts.
    texts = [f"{name}_{i}" if name in names[:i] else name for i, name in enumerate(names)]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in texts])
    lines = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(sorted(files))
    return lines.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STATEMENT_FIELDS])


def load_statement(lines: DataFrame, store: str = STORE) -> DataFrame:
    """One store's lines with ``month`` as DATE; an unreadable or empty sale month fails the load."""
    text = F.col("sale_month")
    unreadable = F.raise_error(
        F.concat(F.lit("unreadable sale_month: "), F.coalesce(text, F.lit("empty")))
    ).cast("date")
    month = F.coalesce(statement_month(text), unreadable)
    return lines.where(F.col("store") == store).select(
        "isrc", month.alias("month"), "country_code", "streams", "revenue", "currency"
    )
