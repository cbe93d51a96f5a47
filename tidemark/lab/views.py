"""Views of the benchmark tables in the shape of the stored facts.

Each view joins only the tables whose columns the caller asks for: every order line has its
order, customer, nation and part, so leaving a join out changes no row.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import month_of
from tidemark.operators.spread import counted, spread_join

SPEND_FROM, SPEND_BEFORE = date(1997, 3, 10), date(1999, 2, 21)
AS_OF = date(2001, 7, 27)
COHORT_AS_OF = date(2024, 1, 8)
LAST_SLOT = 45


# Columns of the given tables: declared, so that no job has to read file footers first.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Order lines as engagement rows; ``extra`` of country, currency, part adds its columns."""
    rows = table(spark, sf_dir, "lineitem")
    if {"country", "currency"} & set(extra):
        orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
        if "country" in extra:
            # Orders meet their country first, so that the lines move once.
            customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
            nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
            orders = orders.join(customers, "o_custkey").join(nations, "c_nationkey")
        rows = rows.join(orders, "l_orderkey")
    if "part" in extra:
        parts = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
        rows = rows.join(parts, "l_partkey")

    day = F.col("l_shipdate").cast("date")
    spending = (day >= F.lit(SPEND_FROM)) & (day < F.lit(SPEND_BEFORE))
    spend = F.col("l_extendedprice").cast("decimal(18,2)")
    context = (
        F.when(F.col("l_returnflag") == "R", "playlist")
        .when(F.col("l_returnflag") == "A", "catalog")
        .otherwise("other")
    )
    columns = {
        "campaign_id": F.col("l_suppkey"),
        "report_date": day,
        "engagement_context": context,
        "engaged_spotify_track_id": F.col("l_partkey"),
        "engaged_track_isrc": F.floor(F.sqrt(F.col("l_partkey") % 400)).cast("bigint"),
        "streams": F.col("l_quantity").cast("bigint"),
        "spend_total": F.when(spending, spend).otherwise(F.lit(0).cast("decimal(18,2)")),
        "order_key": F.col("l_orderkey"),
        "line_number": F.col("l_linenumber"),
        "l_extendedprice": F.col("l_extendedprice"),
        "l_discount": F.col("l_discount"),
        "l_linestatus": F.col("l_linestatus"),
    }
    if "country" in extra:
        columns["country_code"] = F.col("n_name")
    if "currency" in extra:
        is_eur = F.col("o_orderstatus") == "F"
        columns["currency"] = F.when(is_eur, "EUR").otherwise("USD")
    if "part" in extra:
        columns["playlist_position"] = F.when(F.col("p_size") <= LAST_SLOT, F.col("p_size"))
        columns["engaged_track_name"] = F.col("p_name")
    return rows.select(*[column.alias(name) for name, column in columns.items()])


def country_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend and streams per campaign, day and country."""
    rows = lines(spark, sf_dir, "country")
    return rows.groupBy("campaign_id", "report_date", "country_code").agg(
        F.sum("spend_total").alias("spend_total"), F.sum("streams").alias("streams")
    )


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target per campaign: the largest catalog code, and the smallest track id with it."""
    catalog = lines(spark, sf_dir).where(F.col("engagement_context") == "catalog")
    per_code = catalog.groupBy("campaign_id", "engaged_track_isrc").agg(
        F.min("engaged_spotify_track_id").alias("track")
    )
    per_campaign = per_code.groupBy("campaign_id").agg(
        F.max("engaged_track_isrc").alias("campaign_target_isrc"),
        F.max_by("track", "engaged_track_isrc").alias("campaign_target_spotify_track_id"),
    )
    kind = F.when(F.col("campaign_id") % 2 == 0, "playlist").otherwise("track")
    return per_campaign.withColumn("campaign_target_type", kind)


def targeted(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Engagement rows with their campaign's target columns."""
    rows = lines(spark, sf_dir, *extra)
    lookup = counted(targets(spark, sf_dir))
    return spread_join(rows, lookup, "campaign_id", spread_by=("engaged_spotify_track_id",))


def statement_lines(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Statement lines of all stores; ``extra`` of country, currency adds the column."""
    rows = lines(spark, sf_dir, *extra)
    silent = (F.col("engaged_track_isrc") + F.month("report_date")) % 10 == 0
    chosen = [name for name in ("country_code", "currency") if name in rows.columns]
    return rows.select(
        F.col("engaged_track_isrc").alias("isrc"),
        F.when(F.col("l_linestatus") == "F", "Spotify").otherwise("Elsewhere").alias("store"),
        month_of(F.col("report_date")).alias("month"),
        F.when(silent, F.lit(0).cast("bigint")).otherwise(F.col("streams")).alias("streams"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        *chosen,
    )


def statement(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """The loaded statement: one store, ``month`` as DATE."""
    rows = statement_lines(spark, sf_dir, *extra)
    return rows.where(F.col("store") == "Spotify").drop("store")


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as campaigns with a status."""
    suppliers = table(spark, sf_dir, "supplier")
    status = F.when(F.col("s_acctbal") < 0, "paused").otherwise("active")
    return suppliers.select(F.col("s_suppkey").alias("campaign_id"), status.alias("status"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as entities with a creation day."""
    orders = table(spark, sf_dir, "orders")
    created = F.col("o_orderdate").cast("date")
    return orders.select(F.col("o_orderkey").alias("entity_id"), created.alias("created_date"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as request results: quarter hours are runs, users are entities in batches of 50.

    Signups and clicks are breakdown requests of the whole batch, views are engagement, purchases
    retention; an error is a failed request of a kind given by its id.
    """
    events = table(spark, sf_dir, "events")
    minute = F.hour("ts") * 60 + F.minute("ts")
    kind = (
        F.when(F.col("event_type").isin("click", "signup"), "breakdown")
        .when(F.col("event_type") == "view", "engagement")
        .when(F.col("event_type") == "purchase", "retention")
        .when(F.col("event_id") % 4 <= 1, "retention")
        .when(F.col("event_id") % 4 == 2, "breakdown")
        .otherwise("engagement")
    )
    failed = F.col("event_type") == "error"
    refused = F.col("event_id") % 3 == 0
    return events.select(
        F.col("ts").cast("date").alias("run_day"),
        F.floor(minute / 15).cast("bigint").alias("run_slot"),
        F.floor(F.col("user_id") / 50).cast("bigint").alias("batch"),
        F.col("user_id").alias("entity_id"),
        F.floor((minute % 15) / 5).cast("bigint").alias("window_start"),
        kind.alias("kind"),
        (~failed).alias("ok"),
        F.when(~failed, 200).when(refused, 403).otherwise(500).alias("status"),
        F.when(failed, "request failed").alias("message"),
        F.when(failed & refused, '{"code": "PREMIUM_PLAN_REQUIRED"}').alias("body"),
        F.floor("value").cast("bigint").alias("rows"),
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as user activity: signups join, clicks count as streams."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "user_id",
        F.col("ts").cast("date").alias("day"),
        (F.col("event_type") == "signup").alias("joins"),
        F.when(F.col("event_type") == "click", 1).otherwise(0).cast("bigint").alias("streams"),
    )
