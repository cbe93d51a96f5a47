"""Registered queries: landed files, validation, stored tables and streaming.

Each query writes the given tables out as landed files in the shared scratch folder and reads
them back through the library.
"""

from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import jobs
from tidemark.functions import own_offset_date
from tidemark.lab import analyses, sql, views
from tidemark.operators import attribution, quality, retention
from tidemark.operators.upsert import latest_by_key, upsert
from tidemark.plans.requests import numbered
from tidemark.schemas import LAST_SYNC, PROGRESS, STATEMENT, TableSpec, campaign_specs, link_specs
from tidemark.session import Scratch, pinned, scratch_dir
from tidemark.sources import (
    SnapshotStore,
    check_pages,
    find_entity,
    load_statement,
    read_export,
    read_lines,
    read_pages,
    read_statement,
    reconcile_counts,
)
from tidemark.sources.decode import decode_rows, split_valid
from tidemark.sources.pages import created_days
from tidemark.streaming import late_split, stream_exports

CAMPAIGNS = campaign_specs()
LINKS = link_specs()
BREAKDOWN, ENGAGEMENT = CAMPAIGNS["breakdown"], CAMPAIGNS["engagement"]
RETENTION = LINKS["retention"]
RANGE = date(1997, 3, 10), date(1997, 6, 7)
PAGE_SIZE = 25
SYNCED = datetime(2001, 7, 27, 6, 0)
# Landed text repeats its field names; the fastest level already leaves little of them.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
# On a local disk every file and its checksum file cost some processes that set their permissions;
# small files landed in great numbers go without checksum files. Other file systems are not concerned.
BARE = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def _month_number(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def export_name(file: str = "file") -> Column:
    """The landed folder a line came from: one export per month."""
    return F.replace(F.regexp_extract(file, "window=([0-9]+-[0-9]+)", 1), F.lit("-"), F.lit("")).cast("int")


def land(
    rows: DataFrame, name: str, value: Column, by: tuple[str, ...] = ("window",), placed: bool = False
) -> str:
    """Write lines as compressed text files, a folder per month named by its first day.

    ``rows`` have ship_month and what ``value`` reads: the columns move, the text is made where
    it is written. Rows that are ``placed`` lie together by month and stay where they are.
    """
    path = scratch_dir(rows.sparkSession, name)
    month = F.col("ship_month").cast("string")
    window = F.concat_ws("-", F.substring(month, 1, 4), F.substring(month, 5, 2), F.lit("01"))
    dated = rows.withColumn("window", window)
    sorted_in = dated if placed else dated.hint("rebalance", *by)
    sorted_in.select(value.alias("value"), *by).write.partitionBy(*by).options(**PACKED).text(path)
    return path


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """Rows for files of their own: making a file costs more than its rows, so all cores share them."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, *by)


def dated_lines(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    """Every order line with the month it is landed in."""
    rows = views.lines(spark, sf, *extra)
    return rows.withColumn("ship_month", _month_number(F.col("report_date")))


def breakdown_fields() -> Column:
    """An order line with its country as the fields of a breakdown export row."""
    version = F.when(F.col("line_number") == 7, "1.1").otherwise("1.0")
    return F.struct(
        F.lit("demo").alias("provider"),
        F.concat_ws("-", "order_key", "line_number").alias("account_id"),
        F.col("report_date").cast("string").alias("report_date"),
        F.col("campaign_id").cast("string").alias("campaign_id"),
        "country_code",
        version.alias("schema_version"),
        F.col("engaged_spotify_track_id").alias("impressions"),
        "streams",
        "spend_total",
        F.lit("kept in the raw text only").alias("remark"),
    )


def land_breakdown(
    spark: SparkSession, sf: str, country: Column | None = None, by: tuple[str, ...] = ("window",)
) -> str:
    """Breakdown exports; ``country`` replaces the country code."""
    fields = breakdown_fields()
    if country is not None:
        fields = fields.withField("country_code", country)
    rows = dated_lines(spark, sf, "country").withColumn("entity", F.col("campaign_id").cast("string"))
    return land(rows, "breakdown", F.to_json(fields), by)


_ROWS = sql.with_views(sql.LINES)


def export_range_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_export(spark, land_breakdown(spark, sf), BREAKDOWN, *RANGE)
    return rows.select("campaign_id", "report_date", "country_code", "streams", "spend_total")


EXPORT_RANGE_SCAN = f"""{_ROWS}
SELECT CAST(campaign_id AS VARCHAR) AS campaign_id, report_date, country_code, streams,
  CAST(spend_total AS DOUBLE) AS spend_total
FROM lines WHERE report_date BETWEEN DATE '1997-03-10' AND DATE '1997-06-07'"""


def batch_semi_scan(spark: SparkSession, sf: str) -> DataFrame:
    paused = views.campaigns(spark, sf).where(F.col("status") == "paused")
    ids = paused.select(F.col("campaign_id").cast("string").alias("campaign_id"))
    rows = read_export(spark, land_breakdown(spark, sf), BREAKDOWN, ids=ids)
    return rows.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("streams").alias("streams")
    )


BATCH_SEMI_SCAN = f"""{_ROWS}
SELECT CAST(campaign_id AS VARCHAR) AS campaign_id, COUNT(*) AS n_rows,
  CAST(SUM(streams) AS BIGINT) AS streams
FROM lines WHERE campaign_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
GROUP BY ALL"""


def entity_folder_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Exports in a folder per campaign: those of campaigns not asked for stay closed."""
    paused = views.campaigns(spark, sf).where(F.col("status") == "paused")
    ids = paused.select(F.col("campaign_id").cast("string").alias("campaign_id"))
    path = land_breakdown(spark, sf, by=("entity",))
    rows = read_export(spark, path, BREAKDOWN, *RANGE, ids=ids)
    return rows.groupBy("campaign_id", "country_code").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("streams").alias("streams")
    )


ENTITY_FOLDER_SCAN = f"""{_ROWS}
SELECT CAST(campaign_id AS VARCHAR) AS campaign_id, country_code, COUNT(*) AS n_rows,
  CAST(SUM(streams) AS BIGINT) AS streams
FROM lines WHERE campaign_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
  AND report_date BETWEEN DATE '1997-03-10' AND DATE '1997-06-07'
GROUP BY ALL"""


def ndjson_decode(spark: SparkSession, sf: str) -> DataFrame:
    text = F.to_json(breakdown_fields())
    cut = F.col("line_number") == 7
    mistyped = (F.col("line_number") == 3) & (F.col("engagement_context") == "other")
    value = (
        F.when(cut, F.substring(text, 1, 40))
        .when(mistyped, F.regexp_replace(text, r'"streams":\d+', '"streams":"many"'))
        .when(F.col("line_number") == 5, F.concat(text, F.lit("\n\n   ")))
        .otherwise(text)
    )
    path = land(dated_lines(spark, sf, "country"), "broken", value)
    return quality.fault_report(decode_rows(read_lines(spark, path), BREAKDOWN))


NDJSON_DECODE = f"""{_ROWS}
SELECT CASE WHEN line_number = 7 OR (line_number = 3 AND engagement_context = 'other')
    THEN 'undecodable' ELSE 'ok' END AS fault, COUNT(*) AS rows
FROM lines GROUP BY fault"""


def row_count_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_lines(spark, land_breakdown(spark, sf)).select(export_name().alias("export"))
    month = _month_number(F.col("report_date")).alias("export")
    declared = F.count(F.lit(1)) + F.when(F.col("export") % 100 == 6, 1).otherwise(0)
    manifest = views.lines(spark, sf).groupBy(month).agg(declared.alias("expected"))
    return reconcile_counts(rows, manifest)


ROW_COUNT_RECONCILE = f"""{_ROWS}
SELECT CAST(year(report_date) * 100 + month(report_date) AS INTEGER) AS export,
  COUNT(*) + 1 AS expected, COUNT(*) AS found
FROM lines WHERE month(report_date) = 6 GROUP BY export"""


def key_validation(spark: SparkSession, sf: str) -> DataFrame:
    fields = breakdown_fields()
    no_country = F.when(F.col("line_number") != 6, fields["country_code"])
    odd_day = (F.col("line_number") == 5) & (F.col("engagement_context") == "catalog")
    day = F.when(odd_day, "soon").otherwise(fields["report_date"])
    fields = fields.withField("country_code", no_country).withField("report_date", day)
    numeric = (F.col("line_number") == 4) & (F.col("engagement_context") == "playlist")
    text = F.to_json(fields)
    unquoted = F.regexp_replace(text, r'"campaign_id":"(\d+)"', r'"campaign_id":$1')
    value = F.when(numeric, unquoted).otherwise(text)
    path = land(dated_lines(spark, sf, "country"), "keys", value)
    decoded = pinned(decode_rows(read_lines(spark, path), BREAKDOWN), "decoded")
    good, aside = split_valid(decoded)
    bad = aside.select(F.explode("faults").alias("fault")).groupBy("fault").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    fine = good.agg(F.lit("ok").alias("fault"), F.count(F.lit(1)).alias("n_rows"))
    return bad.unionByName(fine)


KEY_VALIDATION = f"""{_ROWS}
SELECT CASE WHEN line_number = 6 THEN 'country_code: missing'
    WHEN line_number = 5 AND engagement_context = 'catalog' THEN 'report_date: not a date'
    WHEN line_number = 4 AND engagement_context = 'playlist' THEN 'campaign_id: not text'
    ELSE 'ok' END AS fault, COUNT(*) AS n_rows
FROM lines GROUP BY fault"""


def _checked_specs() -> list[TableSpec]:
    return [*CAMPAIGNS.values(), *LINKS.values()]


def key_validation_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Line n of an order lacks the nth required field, for every table of both families."""
    found = None
    with Scratch(spark) as scratch:
        # The lines move to their months once for all tables.
        lines = dated_lines(spark, sf).select("line_number", "ship_month").hint("rebalance", "ship_month")
        lines = scratch.pin(lines, "lines", by="ship_month")
        for spec in _checked_specs():
            decoded = decode_rows(read_lines(spark, land(lines, spec.name, _lacking_one(spec), placed=True)), spec)
            counted = quality.fault_report(decoded).withColumnRenamed("rows", "n_rows")
            counted = counted.select(F.lit(spec.name).alias("table_name"), "fault", "n_rows")
            found = counted if found is None else found.unionByName(counted)
    return found


def _lacking_one(spec: TableSpec) -> Column:
    """The JSON of a line that lacks the required field of its line number, put together from constants."""
    kinds = {f.name: f.dataType.typeName() for f in spec.fields}
    some = {"string": "x", "date": "2001-07-01", "timestamp": "2001-07-01T00:00:00Z"}
    fields = [
        F.when(F.col("line_number") != n + 1, json.dumps({spec.source_name(name): some.get(kinds[name], 5)})[1:-1])
        for n, name in enumerate(spec.required)
    ]
    version = [F.lit(json.dumps({"schema_version": spec.version})[1:-1])] if spec.version else []
    return F.concat(F.lit("{"), F.concat_ws(",", *fields, *version), F.lit("}"))


KEY_VALIDATION_TABLES = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{spec.name}' AS table_name, CASE l_linenumber "
    + " ".join(f"WHEN {n + 1} THEN '{name}: missing'" for n, name in enumerate(spec.required))
    + " ELSE 'ok' END AS fault, COUNT(*) AS n_rows FROM lineitem GROUP BY ALL"
    for spec in _checked_specs()
) + ")"


WINDOW = "2001-07-20"


def _landed_run(
    spark: SparkSession, sf: str, family: str, store: SnapshotStore, clean: bool = False
) -> jobs.RunReport:
    """A full run over suppliers as links (batches by nation) or as campaigns.

    By the last digit of the key: 1 is created after the run's day and asks for nothing, 3 has a
    bad row, 5 an export without rows, 7 fewer rows than declared, 9 a failed request. The
    breakdown of every sixth nation's batch has a bad row. A ``clean`` run has none of that.
    """
    landing = scratch_dir(spark, f"landing-{family}")
    links = family == "links"
    specs = LINKS if links else CAMPAIGNS
    kind = "engagement" if links else "breakdown"
    key = F.col("s_suppkey")
    digit = F.lit(0) if clean else key % 10
    rows = views.table(spark, sf, "supplier")
    created = F.when(digit == 1, "2001-08-01T00:00:00Z").otherwise("2001-07-20T00:00:00Z")
    known = {
        spec_name: F.lit(5) if field.dataType.typeName() in ("double", "integer") else F.lit("x")
        for field in specs["entities"].fields
        if field.name in specs["entities"].required
        for spec_name in [specs["entities"].source_name(field.name)]
    }
    named = {n: v for n, v in known.items() if n not in ("createdAt", "updatedAt")}
    noun = specs["entities"].key[0]
    named[specs["entities"].source_name(noun)] = key.cast("string")
    times = {n: created for n in known if n in ("createdAt", "updatedAt")}
    item = F.struct(*[v.alias(n) for n, v in {**named, **times}.items()])
    land_listing(rows, "s_suppkey", item, PAGE_SIZE, path=f"{landing}/entities")

    def line(spec: TableSpec, bad: Column) -> Column:
        fields = {n: F.lit("x") for n in spec.required} | {spec.day: F.lit(WINDOW), noun: key.cast("string")}
        fields["country_code"] = F.when(~bad, "DE")
        return F.to_json(F.struct(*[v.alias(n) for n, v in fields.items()], F.lit("1.0").alias("schema_version")))

    batch = F.col("s_nationkey") if links else key
    asked = rows.where(~digit.isin(1, 9)).withColumns({"batch": batch, "entity": key, "window": F.lit(WINDOW)})
    if links:
        bad = F.lit(False) if clean else F.col("s_nationkey") % 6 == 5
        whole = line(specs["breakdown"], bad).alias("value")
        asked.select(whole, "batch", "window").write.partitionBy("batch", "window").text(f"{landing}/breakdown")
    own = F.when(digit != 5, line(specs[kind], digit == 3)).otherwise("").alias("value")
    # A campaign is its own batch, which needs no folder. Entities come last: all share the folders above.
    folders = ["batch", "window", "entity"] if links else ["window", "entity"]
    own_files = spread(asked.select(own, *folders), *folders)
    own_files.write.partitionBy(*folders).options(**BARE).text(f"{landing}/{kind}")
    request = [
        F.lit(kind).alias("kind"),
        batch.cast("string").alias("batch"),
        key.cast("string").alias("entity_id"),
        F.lit(WINDOW).alias("window_start"),
    ]
    declared = F.when(digit == 5, 0).when(digit == 7, 2).otherwise(1).alias("expected")
    asked.select(*request, declared).write.json(f"{landing}/counts")
    rows.where(digit == 9).select(*request, F.lit(500).alias("status")).write.json(f"{landing}/errors")
    return jobs.sync_landing(store, family, specs, landing, "full", views.AS_OF, SYNCED, waves=2)


def landing_run(spark: SparkSession, sf: str) -> DataFrame:
    store = SnapshotStore(spark, scratch_dir(spark, "landed"))
    parts = [
        _landed_run(spark, sf, family, store).outcome.select(F.lit(family).alias("family"), "entity_id", "completed")
        for family in ("links", "campaigns")
    ]
    return parts[0].unionByName(parts[1])


def run_records(spark: SparkSession, sf: str) -> DataFrame:
    """What a run leaves: a failed one its progress, the clean one after it the last-sync record."""
    store = SnapshotStore(spark, scratch_dir(spark, "records"))
    rows = []
    for number, clean in enumerate((False, True)):
        report = _landed_run(spark, sf, "campaigns", store, clean)
        saved = store.read(PROGRESS).agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("run_key").alias("runs"),
            F.max("error_count").alias("errors"),
        ).first()
        told = store.read(LAST_SYNC).first()
        synced = (told["entities"], told["breakdown_rows"], told["mode"]) if told else (None, None, None)
        rows.append((number + 1, report.finished, saved["n"], saved["runs"], saved["errors"], *synced))
    return spark.createDataFrame(
        rows,
        "run int, finished boolean, saved bigint, runs_saved bigint, errors bigint, entities bigint, "
        "breakdown_rows bigint, mode string",
    )


RUN_RECORDS = """
SELECT 1 AS run, false AS finished, COUNT(*) FILTER (s_suppkey % 10 NOT IN (3, 7, 9)) AS saved,
  CAST(1 AS BIGINT) AS runs_saved, COUNT(*) FILTER (s_suppkey % 10 IN (3, 7, 9)) AS errors,
  CAST(NULL AS BIGINT) AS entities, CAST(NULL AS BIGINT) AS breakdown_rows, CAST(NULL AS VARCHAR) AS mode
FROM supplier
UNION ALL
SELECT 2, true, 0, 0, NULL, COUNT(*), COUNT(*), 'full' FROM supplier"""


LANDING_RUN = """
SELECT 'links' AS family, CAST(s_suppkey AS VARCHAR) AS entity_id,
  s_suppkey % 10 NOT IN (3, 7, 9) AS completed
FROM supplier WHERE s_nationkey % 6 <> 5 OR s_suppkey % 10 = 1
UNION ALL
SELECT 'campaigns', CAST(s_suppkey AS VARCHAR), s_suppkey % 10 NOT IN (3, 7, 9) FROM supplier"""


def reject_bad_batches(spark: SparkSession, sf: str) -> DataFrame:
    lost = (F.col("line_number") == 6) & (F.col("ship_month") % 3 == 0)
    country = F.when(~lost, F.col("country_code"))
    store = SnapshotStore(spark, scratch_dir(spark, "rejecting"))
    path = land_breakdown(spark, sf, country)
    jobs.load_export(store, BREAKDOWN, path, SYNCED, on_invalid="reject", export=export_name())
    month = _month_number(F.col("report_date")).alias("ship_month")
    return store.read(BREAKDOWN).groupBy(month).agg(F.count(F.lit(1)).alias("n_rows"))


REJECT_BAD_BATCHES = f"""{_ROWS},
tagged AS (
  SELECT DISTINCT CAST(year(report_date) * 100 + month(report_date) AS INTEGER) AS ship_month,
    order_key, line_number, report_date, campaign_id, country_code FROM lines
)
SELECT ship_month, COUNT(*) AS n_rows FROM tagged
WHERE ship_month NOT IN (SELECT ship_month FROM tagged WHERE line_number = 6 AND ship_month % 3 = 0)
GROUP BY ship_month"""


def schema_version_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.version_report(
        read_export(spark, land_breakdown(spark, sf), BREAKDOWN), BREAKDOWN
    )


SCHEMA_VERSION_REPORT = f"""{_ROWS}
SELECT '1.1' AS schema_version, COUNT(*) AS rows FROM lines WHERE line_number = 7"""


def dq_identities(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.lines(spark, sf)
    extra = F.when(F.col("line_number") == 5, 1).otherwise(0)
    half = F.floor(F.col("streams") / 2)
    media = F.floor(F.col("l_extendedprice") * 0.8)
    slip = F.when(F.col("l_discount") == 0, 0.25).otherwise(0.0)
    price = F.col("l_extendedprice")
    measured = rows.select(
        "engagement_context",
        F.col("line_number").cast("bigint").alias("new_listeners"),
        (F.col("engaged_spotify_track_id") % 7).alias("returning_listeners"),
        (F.col("line_number") + F.col("engaged_spotify_track_id") % 7 + extra).alias("listeners"),
        half.alias("new_listener_streams"),
        (F.col("streams") - half).alias("returning_listener_streams"),
        "streams",
        media.cast("double").alias("spend_media"),
        price.alias("spend_total"),
        (price - media + slip).alias("fees"),
    )
    report = quality.identity_report(measured, "engagement_context")
    return report.select(
        "engagement_context", "rows", "bad_listeners", "bad_streams", "bad_spend_total",
        "negative_streams", "negative_fees",
    )


DQ_IDENTITIES = f"""{_ROWS}
SELECT engagement_context, COUNT(*) AS rows, COUNT(*) FILTER (line_number = 5) AS bad_listeners,
  CAST(0 AS BIGINT) AS bad_streams, COUNT(*) FILTER (l_discount = 0) AS bad_spend_total,
  CAST(0 AS BIGINT) AS negative_streams, CAST(0 AS BIGINT) AS negative_fees
FROM lines GROUP BY engagement_context"""


def project_country_daily(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_export(spark, land_breakdown(spark, sf), BREAKDOWN)
    remark = F.get_json_object("raw_json", "$.remark").alias("remark")
    return rows.select(
        "provider", "account_id", "report_date", "campaign_id", "country_code", "impressions",
        "streams", "spend_total", "followers", "currency", remark,
    )


PROJECT_COUNTRY_DAILY = f"""{_ROWS}
SELECT 'demo' AS provider, order_key || '-' || line_number AS account_id, report_date,
  CAST(campaign_id AS VARCHAR) AS campaign_id, country_code, track_id AS impressions, streams,
  CAST(spend_total AS DOUBLE) AS spend_total, CAST(NULL AS BIGINT) AS followers,
  CAST(NULL AS VARCHAR) AS currency, 'kept in the raw text only' AS remark
FROM lines"""


def project_engagement_daily(spark: SparkSession, sf: str) -> DataFrame:
    fields = F.struct(
        F.lit("demo").alias("provider"),
        F.concat_ws("-", "order_key", "line_number").alias("account_id"),
        F.col("report_date").cast("string").alias("report_date"),
        F.col("campaign_id").cast("string").alias("campaign_id"),
        "engagement_context",
        "country_code",
        F.col("engaged_spotify_track_id").cast("string").alias("engaged_spotify_track_id"),
        F.col("engaged_track_isrc").cast("string").alias("engaged_track_isrc"),
        "engaged_track_name",
        "playlist_position",
        "streams",
    )
    path = land(dated_lines(spark, sf, "country", "part"), "engagement", F.to_json(fields))
    return read_export(spark, path, ENGAGEMENT).select(
        "account_id", "report_date", "campaign_id", "engagement_context", "country_code",
        "engaged_spotify_track_id", "engaged_track_isrc", "engaged_track_name",
        "playlist_position", "streams", "status",
    )


PROJECT_ENGAGEMENT_DAILY = f"""{_ROWS}
SELECT order_key || '-' || line_number AS account_id, report_date,
  CAST(campaign_id AS VARCHAR) AS campaign_id, engagement_context, country_code,
  CAST(track_id AS VARCHAR) AS engaged_spotify_track_id,
  CAST(isrc AS VARCHAR) AS engaged_track_isrc, track_name AS engaged_track_name,
  playlist_position, streams, CAST(NULL AS VARCHAR) AS status
FROM lines"""


def land_listing(
    rows: DataFrame,
    order: str,
    item: Column,
    page_size: int,
    lost_page: int | None = None,
    path: str | None = None,
) -> str:
    """Rows as listing pages, one file each, in the given order."""
    spark = rows.sparkSession
    total = rows.count()
    placed = numbered(rows.select(F.col(order), item.alias("item")), order)
    page = (F.floor(F.col("position") / page_size) + 1).cast("int").alias("page")
    grouped = placed.groupBy(page).agg(
        F.array_sort(F.collect_list(F.struct("position", "item"))).alias("items")
    )
    if lost_page is not None:
        grouped = grouped.where(F.col("page") != lost_page)
    pagination = F.struct(
        "page",
        F.lit(page_size).alias("pageSize"),
        F.lit(total).alias("totalCount"),
        F.lit(-(-total // page_size)).alias("totalPages"),
    )
    data = F.struct(F.col("items")["item"].alias("items"), pagination.alias("pagination"))
    path = path or scratch_dir(spark, "pages")
    envelope = grouped.select(F.to_json(F.struct(data.alias("data"))).alias("value"), "page")
    spread(envelope, "page").write.partitionBy("page").options(**BARE).text(path)
    return path


def land_pages(
    spark: SparkSession, sf: str, lost_page: int | None = None, status: str = "active"
) -> str:
    """Suppliers as campaign listing pages of 25 items; ``status`` is that of unpaused ones."""
    key = F.col("s_suppkey")
    day = F.date_format(F.date_add(F.lit(date(1997, 1, 1)), (key % 365).cast("int")), "yyyy-MM-dd")
    offset = F.when(key % 2 == 1, "-05:00").otherwise("Z")
    item = F.struct(
        key.cast("string").alias("campaignId"),
        F.concat(F.lit("org-"), F.col("s_nationkey")).alias("organizationId"),
        F.when(F.col("s_acctbal") < 0, "paused").otherwise(status).alias("status"),
        F.lit("meta").alias("socialPlatform"),
        F.col("s_acctbal").alias("dailyBudget"),
        (F.col("s_acctbal") * 2).alias("totalBudget"),
        F.lit(30).alias("campaignDuration"),
        (F.col("s_nationkey") % 4).alias("generation"),
        F.concat(day, F.lit("T23:30:00"), offset).alias("createdAt"),
        F.concat(day, F.lit("T23:45:00Z")).alias("updatedAt"),
        F.when(key % 3 != 0, "maximum_growth").alias("strategyType"),
        F.col("s_name").alias("internalName"),
    )
    suppliers = views.table(spark, sf, "supplier")
    return land_listing(suppliers, "s_suppkey", item, PAGE_SIZE, lost_page)


_ITEMS = """
WITH items AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS campaign_id, 'org-' || s_nationkey AS organization_id,
    CASE WHEN s_acctbal < 0 THEN 'paused' ELSE 'active' END AS status, 'meta' AS social_platform,
    s_acctbal AS daily_budget, s_acctbal * 2 AS total_budget, 30 AS campaign_duration,
    s_nationkey % 4 AS generation,
    DATE '1997-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS created_date,
    CASE WHEN s_suppkey % 3 <> 0 THEN 'maximum_growth' END AS strategy_type,
    s_name AS internal_name, s_suppkey,
    CAST(floor((row_number() OVER (ORDER BY s_suppkey) - 1) / 25) + 1 AS INTEGER) AS page
  FROM supplier
)"""


def json_pages_explode(spark: SparkSession, sf: str) -> DataFrame:
    items = read_pages(spark, land_pages(spark, sf), CAMPAIGNS["entities"])
    return items.groupBy("page").agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(F.size("faults") > 0).alias("faulty"),
        F.min(F.col("campaign_id").cast("bigint")).alias("first_id"),
        F.max("position").alias("last_position"),
    )


JSON_PAGES_EXPLODE = f"""{_ITEMS}
SELECT page, COUNT(*) AS items, CAST(0 AS BIGINT) AS faulty, MIN(s_suppkey) AS first_id,
  CAST(COUNT(*) - 1 AS INTEGER) AS last_position
FROM items GROUP BY page"""


def project_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    items = created_days(read_pages(spark, land_pages(spark, sf), CAMPAIGNS["entities"]))
    seconds = {name: F.unix_seconds(name) for name in ("created_at", "updated_at")}
    raw = F.get_json_object("raw_json", "$.internalName").alias("internal_name")
    return items.withColumns(seconds).select(
        "campaign_id", "organization_id", "status", "social_platform", "daily_budget",
        "total_budget", "campaign_duration", "generation", "created_at", "updated_at",
        "strategy_type", "created_date", raw,
    )


PROJECT_CAMPAIGNS = f"""{_ITEMS}
SELECT campaign_id, organization_id, status, social_platform, daily_budget, total_budget,
  campaign_duration, generation, strategy_type, created_date, internal_name,
  CAST(epoch(CAST(created_date AS TIMESTAMP)) AS BIGINT) + 84600
    + CASE WHEN s_suppkey % 2 = 1 THEN 18000 ELSE 0 END AS created_at,
  CAST(epoch(CAST(created_date AS TIMESTAMP)) AS BIGINT) + 85500 AS updated_at
FROM items"""


def page_completeness(spark: SparkSession, sf: str) -> DataFrame:
    whole = check_pages(spark, land_pages(spark, sf)).withColumn("listing", F.lit("whole"))
    short = check_pages(spark, land_pages(spark, sf, lost_page=1)).withColumn(
        "listing", F.lit("page lost")
    )
    return whole.unionByName(short)


PAGE_COMPLETENESS = f"""{_ITEMS},
sums AS (
  SELECT COUNT(*) AS items, MAX(page) AS pages, COUNT(*) FILTER (page = 1) AS lost FROM items
)
SELECT 'whole' AS listing, CAST(pages AS BIGINT) AS pages_found, pages AS pages_expected,
  items AS items_found, items AS items_expected, CAST(0 AS BIGINT) AS unreadable, true AS complete
FROM sums
UNION ALL
SELECT 'page lost', pages - 1, CASE WHEN pages > 1 THEN pages ELSE 0 END, items - lost,
  CASE WHEN pages > 1 THEN items ELSE 0 END, 0, pages <= 1 FROM sums"""


def entity_lookup(spark: SparkSession, sf: str) -> DataFrame:
    items = read_pages(spark, land_pages(spark, sf), CAMPAIGNS["entities"])
    return find_entity(items, "campaign_id", "7").select("campaign_id", "status", "daily_budget")


ENTITY_LOOKUP = f"{_ITEMS} SELECT campaign_id, status, daily_budget FROM items WHERE s_suppkey = 7"


def land_statement(spark: SparkSession, sf: str) -> str:
    """All statement lines as CSV with a header."""
    lines = views.statement_lines(spark, sf, "country", "currency").select(
        F.col("isrc").cast("string").alias("isrc"),
        "store",
        F.date_format("month", "yyyy-MM").alias("sale_month"),
        "country_code",
        "streams",
        "revenue",
        "currency",
    )
    path = scratch_dir(spark, "statement")
    lines.write.option("header", True).csv(path)
    return path


def statement_monthly(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_statement(spark, land_statement(spark, sf))
    return attribution.statement_monthly(load_statement(lines))


def statement_table(spark: SparkSession, sf: str) -> DataFrame:
    """The stored statement after replacing it, by country and currency."""
    store = SnapshotStore(spark, scratch_dir(spark, "statements"))
    jobs.load_statement_table(store, land_statement(spark, sf), SYNCED)
    return store.read(STATEMENT).groupBy("month", "country_code", "currency").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("streams").alias("streams"),
        F.round(F.sum("revenue"), 6).alias("revenue"),
    )


STATEMENT_TABLE = f"""{sql.with_views(sql.LINES, sql.STATEMENT)}
SELECT month, country_code, currency, COUNT(*) AS n_rows,
  CAST(SUM(streams) AS BIGINT) AS streams,
  ROUND(SUM(revenue), 6) AS revenue
FROM statement GROUP BY ALL"""

STATEMENT_MONTHLY = f"""{sql.with_views(sql.LINES, sql.STATEMENT, sql.DISTRIBUTOR)}
SELECT CAST(isrc AS VARCHAR) AS isrc, month, distributor_streams FROM distributor"""


def retention_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Computed cohorts, landed as retention exports and upserted into the wide table."""
    cohorts = retention.cohort_retention(views.activity(spark, sf), views.COHORT_AS_OF)
    fields = F.struct(
        F.lit("demo").alias("provider"),
        F.lit("acct").alias("account_id"),
        F.lit("link-1").alias("link_id"),
        F.lit("US").alias("country_code"),
        F.lit(RETENTION.version).alias("schema_version"),
        *[F.col(name) for name in cohorts.columns],
    )
    dated = cohorts.withColumn("ship_month", _month_number(F.col("cohort_date")))
    path = land(dated, "retention", F.to_json(fields))
    return loaded(spark, RETENTION, path).select(*cohorts.columns)


def loaded(spark: SparkSession, spec: TableSpec, *paths: str) -> DataFrame:
    """The table after loading landed exports one after the other."""
    store = SnapshotStore(spark, scratch_dir(spark, f"stored-{spec.name}"))
    for path in paths:
        jobs.load_export(store, spec, path, SYNCED)
    return store.read(spec)


def campaign_listing_load(spark: SparkSession, sf: str) -> DataFrame:
    """A listing upserted twice; the second shows another status."""
    store = SnapshotStore(spark, scratch_dir(spark, "campaigns"))
    for status in ("active", "ended"):
        path = land_pages(spark, sf, status=status)
        jobs.load_entities(store, CAMPAIGNS["entities"], path, SYNCED)
    return store.read(CAMPAIGNS["entities"]).groupBy("status").agg(
        F.count(F.lit(1)).alias("campaigns"), F.sum("generation").alias("generations")
    )


CAMPAIGN_LISTING_LOAD = f"""{_ITEMS}
SELECT CASE WHEN status = 'active' THEN 'ended' ELSE status END AS status,
  COUNT(*) AS campaigns, CAST(SUM(generation) AS BIGINT) AS generations
FROM items GROUP BY 1"""


def link_listing_load(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as link listing pages of 100 items, loaded and read back."""
    key = F.col("p_partkey")
    day = F.date_format(F.date_add(F.lit(date(1997, 1, 1)), (key % 365).cast("int")), "yyyy-MM-dd")
    item = F.struct(
        key.cast("string").alias("linkId"),
        F.col("p_brand").alias("organizationId"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("https://link.example/"), key).alias("url"),
        F.when(F.col("p_size") > 25, "track").alias("targetType"),
        F.col("p_type").alias("status"),
        F.concat(day, F.lit("T10:00:00.000Z")).alias("createdAt"),
    )
    path = land_listing(views.table(spark, sf, "part"), "p_partkey", item, 100)
    store = SnapshotStore(spark, scratch_dir(spark, "links"))
    jobs.load_entities(store, LINKS["entities"], path, SYNCED)
    return created_days(store.read(LINKS["entities"])).select(
        "link_id", "organization_id", "name", "url", "target_type", "spotify_url", "status",
        "created_date",
    )


LINK_LISTING_LOAD = """
SELECT CAST(p_partkey AS VARCHAR) AS link_id, p_brand AS organization_id, p_name AS name,
  'https://link.example/' || p_partkey AS url, CASE WHEN p_size > 25 THEN 'track' END AS target_type,
  CAST(NULL AS VARCHAR) AS spotify_url, p_type AS status,
  DATE '1997-01-01' + CAST(p_partkey % 365 AS INTEGER) AS created_date
FROM part"""


def _link_fields(*more: Column) -> Column:
    return F.struct(
        F.lit("demo").alias("provider"),
        F.concat_ws("-", "order_key", "line_number").alias("account_id"),
        F.col("report_date").cast("string").alias("report_date"),
        F.col("engaged_spotify_track_id").cast("string").alias("link_id"),
        F.lit("1.0").alias("schema_version"),
        "streams",
        *more,
    )


def link_breakdown_load(spark: SparkSession, sf: str) -> DataFrame:
    fields = _link_fields(
        F.col("country_code"),
        F.col("line_number").alias("views"),
        F.round(F.col("line_number") / 8, 4).alias("ctr_lp"),
    )
    path = land(dated_lines(spark, sf, "country"), "link-breakdown", F.to_json(fields))
    return loaded(spark, LINKS["breakdown"], path).groupBy("link_id").agg(
        F.count_distinct("account_id", "report_date", "country_code").alias("n_keys"),
        F.count("views").alias("with_views"),
        F.max("ctr_lp").alias("best_ctr"),
    )


LINK_BREAKDOWN_LOAD = f"""{_ROWS},
keys AS (
  SELECT track_id, order_key, line_number, report_date, country_code FROM lines GROUP BY ALL
)
SELECT CAST(track_id AS VARCHAR) AS link_id, COUNT(*) AS n_keys, COUNT(*) AS with_views,
  MAX(line_number) / 8.0 AS best_ctr
FROM keys GROUP BY track_id"""


def _engagement_load(spark: SparkSession, sf: str, spec: TableSpec) -> DataFrame:
    fields = _link_fields(
        F.col("campaign_id").cast("string").alias("campaign_id"),
        F.col("country_code"),
        F.col("engagement_context"),
        F.col("engaged_spotify_track_id").cast("string").alias("engaged_spotify_track_id"),
        F.col("engaged_track_isrc").cast("string").alias("engaged_track_isrc"),
        F.col("engaged_track_name"),
        F.col("playlist_position"),
    )
    path = land(dated_lines(spark, sf, "country", "part"), spec.name, F.to_json(fields))
    return loaded(spark, spec, path).groupBy("engagement_context", "engaged_track_isrc").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("playlist_position").alias("placed"),
        F.max("engaged_track_name").alias("track_name"),
    )


def campaign_engagement_load(spark: SparkSession, sf: str) -> DataFrame:
    return _engagement_load(spark, sf, ENGAGEMENT)


def link_engagement_load(spark: SparkSession, sf: str) -> DataFrame:
    return _engagement_load(spark, sf, LINKS["engagement"])


_ENGAGEMENT_KEYS = """
SELECT engagement_context, CAST(isrc AS VARCHAR) AS engaged_track_isrc, COUNT(*) AS n_rows,
  COUNT(playlist_position) AS placed, MAX(track_name) AS track_name
FROM (SELECT DISTINCT order_key, line_number, report_date, campaign_id, engagement_context,
    country_code, track_id, isrc, playlist_position, track_name FROM lines)
GROUP BY ALL"""

CAMPAIGN_ENGAGEMENT_LOAD = f"{_ROWS} {_ENGAGEMENT_KEYS}"
LINK_ENGAGEMENT_LOAD = f"{_ROWS} {_ENGAGEMENT_KEYS.replace('campaign_id, ', '')}"


def raw_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A field outside the contract, read back from the text the decoder keeps."""
    known = {name: F.lit("x") for name in BREAKDOWN.required} | {BREAKDOWN.day: F.lit("2001-07-01")}
    line = F.struct(*[value.alias(name) for name, value in known.items()], F.lit("1.0").alias("schema_version"))
    text = F.concat(F.regexp_replace(F.to_json(line), r"\}$", ', "extra": '), "props", F.lit("}"))
    path = scratch_dir(spark, "props")
    views.table(spark, sf, "events").select(text.alias("value")).write.text(path)
    decoded, _ = split_valid(decode_rows(read_lines(spark, path), BREAKDOWN))
    by_path = F.get_json_object("raw_json", "$.extra.k").cast("bigint").alias("k")
    by_variant = F.try_variant_get(F.try_parse_json("raw_json"), "$.extra.k", "bigint")
    return decoded.groupBy(by_path).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(by_variant).alias("k_sum")
    )


RAW_JSON_ROUNDTRIP = """
SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, COUNT(*) AS n_rows,
  CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum
FROM events GROUP BY k"""


def created_date_own_offset(spark: SparkSession, sf: str) -> DataFrame:
    orders = views.table(spark, sf, "orders")
    offset = F.when(F.col("o_orderkey") % 2 == 1, "-05:00").otherwise("+00:00")
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T23:30:00"), offset)
    own = own_offset_date(text)
    utc_day = F.floor(F.unix_seconds(text.cast("timestamp")) / 86400)
    shifted = utc_day != F.unix_date(own)
    return orders.groupBy(own.alias("created_date")).agg(
        F.count(F.lit(1)).alias("entities"), F.count_if(shifted).alias("shifted")
    )


CREATED_DATE_OWN_OFFSET = """
SELECT CAST(o_orderdate AS DATE) AS created_date, COUNT(*) AS entities,
  COUNT(*) FILTER (o_orderkey % 2 = 1) AS shifted FROM orders GROUP BY 1"""


def latest_rows_by_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.table(spark, sf, "lineitem")
    rows = rows.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return latest_by_key(rows, ("l_orderkey", "l_linenumber"), ("l_shipdate",))


LATEST_BY_KEY = """
SELECT * EXCLUDE (l_shipdate, place), CAST(l_shipdate AS DATE) AS l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
    l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
    l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS place
  FROM lineitem)
WHERE place = 1"""


def stored_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines in the stored breakdown shape, with the columns that order duplicates."""
    return views.lines(spark, sf).select(
        F.lit("demo").alias("provider"),
        F.lit("acct").alias("account_id"),
        "report_date",
        F.col("campaign_id").cast("string").alias("campaign_id"),
        F.col("engagement_context").alias("country_code"),
        "streams",
        F.col("spend_total").cast("double").alias("spend_total"),
        F.lit("{}").alias("raw_json"),
        "order_key",
        "line_number",
        F.col("engaged_spotify_track_id").alias("track"),
    )


_ORDER = ("order_key", "line_number", "track", "streams")


def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    rows = stored_rows(spark, sf)
    later = rows.where(F.col("line_number") >= 4).withColumn("streams", F.col("streams") + 1000)
    store = SnapshotStore(spark, scratch_dir(spark, "merging"))
    upsert(store, BREAKDOWN, rows.where(F.col("line_number") <= 4), SYNCED, _ORDER)
    upsert(store, BREAKDOWN, later, SYNCED, _ORDER)
    return store.read(BREAKDOWN).select(
        "campaign_id", "report_date", "country_code", "streams", "spend_total"
    )


UPSERT_MERGE = f"""{_ROWS},
given AS (
  SELECT 1 AS batch, * FROM lines WHERE line_number <= 4
  UNION ALL BY NAME
  SELECT 2 AS batch, * REPLACE (streams + 1000 AS streams) FROM lines WHERE line_number >= 4
)
SELECT CAST(campaign_id AS VARCHAR) AS campaign_id, report_date,
  engagement_context AS country_code, streams, CAST(spend_total AS DOUBLE) AS spend_total
FROM given
QUALIFY row_number() OVER (PARTITION BY campaign_id, report_date, engagement_context
  ORDER BY batch DESC, order_key DESC, line_number DESC, track_id DESC, streams DESC,
    spend_total DESC) = 1"""


def schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    early_fields = [f for f in BREAKDOWN.fields if f.name not in ("currency", "cpl", "result_type")]
    early = TableSpec(
        BREAKDOWN.name, BREAKDOWN.key, T.StructType(early_fields), BREAKDOWN.key, BREAKDOWN.day
    )
    rows = stored_rows(spark, sf)
    store = SnapshotStore(spark, scratch_dir(spark, "evolving"))
    store.ensure([early])
    upsert(store, early, rows.where(F.col("line_number") <= 4), SYNCED, _ORDER)
    store.ensure([BREAKDOWN])
    later = rows.where(F.col("line_number") >= 4).withColumn("currency", F.lit("USD"))
    upsert(store, BREAKDOWN, later, SYNCED, _ORDER)
    stored = store.read(BREAKDOWN)
    return stored.groupBy("country_code", "currency").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("cpl").alias("with_cpl")
    )


SCHEMA_EVOLUTION = f"""{_ROWS},
keys AS (
  SELECT campaign_id, report_date, engagement_context AS country_code,
    CASE WHEN MAX(line_number) >= 4 THEN 'USD' END AS currency
  FROM lines GROUP BY ALL
)
SELECT country_code, currency, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS with_cpl
FROM keys GROUP BY ALL"""


def late_rows(spark: SparkSession, sf: str) -> DataFrame:
    fresh, late = late_split(views.lines(spark, sf), "report_date", views.AS_OF)
    parts = fresh.withColumn("part", F.lit("fresh")).unionByName(late.withColumn("part", F.lit("late")))
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("report_date").alias("first_day"),
        F.max("report_date").alias("last_day"),
    )


LATE_SPLIT = f"""{_ROWS}
SELECT CASE WHEN report_date >= DATE '2001-07-18' THEN 'fresh' ELSE 'late' END AS part,
  COUNT(*) AS n_rows, MIN(report_date) AS first_day, MAX(report_date) AS last_day
FROM lines GROUP BY part"""


def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    path = land_breakdown(spark, sf)
    store = SnapshotStore(spark, scratch_dir(spark, "streaming"))
    query = stream_exports(
        spark, path, store, BREAKDOWN, scratch_dir(spark, "progress"), lambda: SYNCED, days=365
    )
    query.awaitTermination()
    month = _month_number(F.col("report_date")).alias("ship_month")
    return store.read(BREAKDOWN).groupBy(month).agg(F.count(F.lit(1)).alias("n_rows"))


STREAM_UPSERT = f"""{_ROWS},
keys AS (
  SELECT DISTINCT order_key, line_number, report_date, campaign_id, country_code FROM lines
  WHERE report_date >= DATE '2000-07-28'
)
SELECT CAST(year(report_date) * 100 + month(report_date) AS INTEGER) AS ship_month,
  COUNT(*) AS n_rows
FROM keys GROUP BY ship_month"""


QUERIES = {
    "json_pages_explode": (json_pages_explode, JSON_PAGES_EXPLODE),
    "page_completeness": (page_completeness, PAGE_COMPLETENESS),
    "entity_lookup": (entity_lookup, ENTITY_LOOKUP),
    "export_range_scan": (export_range_scan, EXPORT_RANGE_SCAN),
    "batch_semi_scan": (batch_semi_scan, BATCH_SEMI_SCAN),
    "entity_folder_scan": (entity_folder_scan, ENTITY_FOLDER_SCAN),
    "ndjson_decode": (ndjson_decode, NDJSON_DECODE),
    "row_count_reconcile": (row_count_reconcile, ROW_COUNT_RECONCILE),
    "key_validation": (key_validation, KEY_VALIDATION),
    "key_validation_tables": (key_validation_tables, KEY_VALIDATION_TABLES),
    "landing_run": (landing_run, LANDING_RUN),
    "run_records": (run_records, RUN_RECORDS),
    "reject_bad_batches": (reject_bad_batches, REJECT_BAD_BATCHES),
    "schema_version_report": (schema_version_report, SCHEMA_VERSION_REPORT),
    "dq_identities": (dq_identities, DQ_IDENTITIES),
    "project_campaigns": (project_campaigns, PROJECT_CAMPAIGNS),
    "project_country_daily": (project_country_daily, PROJECT_COUNTRY_DAILY),
    "project_engagement_daily": (project_engagement_daily, PROJECT_ENGAGEMENT_DAILY),
    "campaign_listing_load": (campaign_listing_load, CAMPAIGN_LISTING_LOAD),
    "campaign_engagement_load": (campaign_engagement_load, CAMPAIGN_ENGAGEMENT_LOAD),
    "link_listing_load": (link_listing_load, LINK_LISTING_LOAD),
    "link_breakdown_load": (link_breakdown_load, LINK_BREAKDOWN_LOAD),
    "link_engagement_load": (link_engagement_load, LINK_ENGAGEMENT_LOAD),
    "statement_monthly": (statement_monthly, STATEMENT_MONTHLY),
    "statement_table": (statement_table, STATEMENT_TABLE),
    "retention_wide": (retention_wide, analyses.COHORT_RETENTION),
    "raw_json_roundtrip": (raw_json_roundtrip, RAW_JSON_ROUNDTRIP),
    "created_date_own_offset": (created_date_own_offset, CREATED_DATE_OWN_OFFSET),
    "latest_by_key": (latest_rows_by_key, LATEST_BY_KEY),
    "upsert_merge": (upsert_merge, UPSERT_MERGE),
    "schema_evolution": (schema_evolution, SCHEMA_EVOLUTION),
    "late_split": (late_rows, LATE_SPLIT),
    "stream_upsert": (stream_upsert, STREAM_UPSERT),
}
