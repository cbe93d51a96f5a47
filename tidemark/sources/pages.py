"""Entity listings landed as page files: {data: {items, pagination}, meta}."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import own_offset_date
from tidemark.schemas import TableSpec
from tidemark.session import few_listing_tasks
from tidemark.sources.decode import decode_rows, raw_field

PAGINATION = T.StructType(
    [
        T.StructField("page", T.IntegerType()),
        T.StructField("pageSize", T.IntegerType()),
        T.StructField("totalCount", T.LongType()),
        T.StructField("totalPages", T.IntegerType()),
    ]
)
ENVELOPE = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("items", T.ArrayType(T.VariantType())),
                    T.StructField("pagination", PAGINATION),
                ]
            ),
        )
    ]
)


class EntityNotFound(LookupError):
    """No entity with the wanted id."""


def _envelopes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    reader = spark.read.schema(ENVELOPE).option("multiLine", True)
    with few_listing_tasks(spark):
        return reader.json(path).select("data", F.col("_metadata.file_path").alias("file"))


def read_pages(spark: SparkSession, path: str | list[str], spec: TableSpec) -> DataFrame:
    """One decoded row per listed entity, with its page and the whole item as ``raw_json``.

    A file without ``data`` gives one row that is faulty as a whole.
    """
    pages = _envelopes(spark, path)
    items = pages.select(
        "file",
        F.col("data.pagination.page").alias("page"),
        F.posexplode_outer("data.items").alias("position", "item"),
        F.col("data").isNull().alias("no_data"),
    )
    listed = items.where(F.col("item").isNotNull() | F.col("no_data")).select(
        F.to_json("item").alias("value"), "file", "page", "position"
    )
    return decode_rows(listed, spec)


def read_entity(spark: SparkSession, path: str | list[str], spec: TableSpec) -> DataFrame:
    """Entities landed one by one, each in an envelope of its own: {data: {...}, meta}.

    A file whose ``data`` is missing or null gives one faulty row, as in a listing.
    """
    schema = T.StructType([T.StructField("data", T.VariantType())])
    with few_listing_tasks(spark):
        landed = spark.read.schema(schema).option("multiLine", True).json(path)
    items = landed.select(
        F.to_json("data").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.lit(1).alias("page"),
        F.lit(0).alias("position"),
    )
    return decode_rows(items, spec)


def created_days(entities: DataFrame) -> DataFrame:
    """Adds ``created_date``, the day as written in the entity's own time offset."""
    created = raw_field(entities, "$.createdAt")
    return entities.withColumn("created_date", own_offset_date(created))


def check_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row telling whether all pages and all items of a listing have landed."""
    pages = _envelopes(spark, path).select(
        F.col("data.pagination.page").alias("page"),
        F.col("data.pagination.totalPages").alias("total_pages"),
        F.col("data.pagination.totalCount").alias("total_count"),
        F.coalesce(F.size("data.items"), F.lit(0)).alias("items"),
        F.col("data").isNull().alias("no_data"),
    )
    return listing_report(pages)


def listing_report(pages: DataFrame) -> DataFrame:
    """Completeness of (page, total_pages, total_count, items, no_data) rows."""
    once = pages.groupBy("page").agg(
        F.max("total_pages").alias("total_pages"),
        F.max("total_count").alias("total_count"),
        F.max("items").alias("items"),
        F.count_if("no_data").alias("unreadable"),
    )
    report = once.agg(
        F.count("page").alias("pages_found"),
        F.coalesce(F.max("total_pages"), F.lit(0)).alias("pages_expected"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("items_found"),
        F.coalesce(F.max("total_count"), F.lit(0)).alias("items_expected"),
        F.coalesce(F.sum("unreadable"), F.lit(0)).alias("unreadable"),
    )
    complete = (
        (F.col("pages_found") >= F.col("pages_expected"))
        & (F.col("items_found") == F.col("items_expected"))
        & (F.col("unreadable") == 0)
    )
    return report.withColumn("complete", complete)


def find_entity(entities: DataFrame, column: str, value: object) -> DataFrame:
    """The rows of one entity; raises when there is none."""
    found = entities.where(F.col(column) == F.lit(value))
    if found.isEmpty():
        raise EntityNotFound(f"{column} not found: {value}")
    return found
