"""Registered queries over stored tables: merges, numbered batches, stored sums, pruned periods."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.lab import analyses, sql, views
from tidemark.lab.ingest import BREAKDOWN, ENGAGEMENT, SYNCED, spread, stored_rows
from tidemark.operators import attribution, quality, rollups
from tidemark.operators.upsert import upsert, write_batch
from tidemark.refresh import engagement_sums, refresh, spend_sums
from tidemark.schemas import link_specs
from tidemark.session import scratch_dir
from tidemark.sources import SnapshotStore, raw_field, read_entity

ORDER = ("order_key", "line_number", "track", "streams")
# Months that the later batches touch.
LATER, LATE = date(2000, 1, 1), (date(1997, 6, 1), date(1997, 6, 30))

_ROWS = sql.with_views(sql.LINES)


def _batches(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Lines up to the fourth of all days, later lines of the last months, late lines of one."""
    rows, line = stored_rows(spark, sf), F.col("line_number")
    return [
        rows.where(line <= 4),
        rows.where((line >= 4) & (F.col("report_date") >= F.lit(LATER))).withColumn("streams", F.col("streams") + 1000),
        rows.where((line >= 3) & F.col("report_date").between(*map(F.lit, LATE))).withColumn(
            "streams", F.col("streams") + 5000
        ),
    ]


_GIVEN = f"""{_ROWS},
given AS (
  SELECT 1 AS batch, * FROM lines WHERE line_number <= 4
  UNION ALL BY NAME
  SELECT 2 AS batch, * REPLACE (streams + 1000 AS streams) FROM lines
    WHERE line_number >= 4 AND report_date >= DATE '{LATER}'
  UNION ALL BY NAME
  SELECT 3 AS batch, * REPLACE (streams + 5000 AS streams) FROM lines
    WHERE line_number >= 3 AND report_date BETWEEN DATE '{LATE[0]}' AND DATE '{LATE[1]}'
),
held AS (
  SELECT * FROM given
  QUALIFY row_number() OVER (PARTITION BY campaign_id, report_date, engagement_context
    ORDER BY batch DESC, order_key DESC, line_number DESC, track_id DESC, streams DESC,
      spend_total DESC) = 1
)"""


def sums_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Sums per campaign and day, kept up to date over an upsert, a second and a late one."""
    store, sums = SnapshotStore(spark, scratch_dir(spark, "refreshed")), spend_sums(BREAKDOWN)
    for batch in _batches(spark, sf):
        upsert(store, BREAKDOWN, batch, SYNCED, ORDER)
        refresh(store, BREAKDOWN, sums)
    return store.read(sums.spec).select(
        F.col("campaign_id").cast("bigint").alias("campaign_id"),
        "report_date",
        "streams",
        F.col("spend_total").cast("double").alias("spend_total"),
    )


SUMS_REFRESH = f"""{_GIVEN}
SELECT campaign_id, report_date, CAST(SUM(streams) AS BIGINT) AS streams,
  CAST(SUM(spend_total) AS DOUBLE) AS spend_total
FROM held GROUP BY campaign_id, report_date"""


def sums_refresh_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Periods that each refresh read: all, then those the batches touched, then none."""
    store, sums = SnapshotStore(spark, scratch_dir(spark, "refreshed")), spend_sums(BREAKDOWN)
    read = []
    for number, batch in enumerate([*_batches(spark, sf), None]):
        if batch is not None:
            upsert(store, BREAKDOWN, batch, SYNCED, ORDER)
        read += [(number + 1, period) for period in refresh(store, BREAKDOWN, sums)]
    return spark.createDataFrame(read, "refresh int, period int")


SUMS_REFRESH_SCAN = f"""{_GIVEN}
SELECT DISTINCT batch AS refresh, CAST(year(report_date) * 100 + month(report_date) AS INTEGER) AS period
FROM given"""


def write_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows given, keys kept and rows of the touched periods, as each write observed them."""
    store = SnapshotStore(spark, scratch_dir(spark, "counted"))
    rows = []
    for number, batch in enumerate(_batches(spark, sf)):
        told = write_batch(store, BREAKDOWN, batch, SYNCED, ORDER)
        rows.append((number + 1, told.given, told.kept, told.repeated, told.stored))
    return spark.createDataFrame(rows, "batch int, given bigint, kept bigint, repeated bigint, stored bigint")


WRITE_COUNTS = f"""{_GIVEN},
keyed AS (
  SELECT batch, campaign_id, report_date, engagement_context, date_trunc('month', report_date) AS month,
    COUNT(*) AS n FROM given GROUP BY ALL
),
touched AS (SELECT DISTINCT batch, month FROM keyed),
after AS (
  SELECT touched.batch, COUNT(DISTINCT (campaign_id, report_date, engagement_context)) AS stored
  FROM touched JOIN keyed ON keyed.month = touched.month AND keyed.batch <= touched.batch
  GROUP BY touched.batch
)
SELECT batch, CAST(SUM(n) AS BIGINT) AS given, COUNT(*) AS kept,
  CAST(SUM(n) - COUNT(*) AS BIGINT) AS repeated, MAX(stored) AS stored
FROM keyed JOIN after USING (batch) GROUP BY batch"""


def replayed_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered batches, each given again after the next: a replay leaves the table as it is."""
    store = SnapshotStore(spark, scratch_dir(spark, "replayed"))
    batches = _batches(spark, sf)
    for number in (0, 0, 1, 0, 1, 2, 1):
        upsert(store, BREAKDOWN, batches[number], SYNCED, ORDER, once=("lines", number))
    month = F.trunc("report_date", "month").alias("month")
    held = store.read(BREAKDOWN).groupBy(month).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("streams").alias("streams")
    )
    return held.withColumn("published", F.lit(store.version(BREAKDOWN)))


REPLAYED_BATCHES = f"""{_GIVEN}
SELECT CAST(date_trunc('month', report_date) AS DATE) AS month, COUNT(*) AS n_rows,
  CAST(SUM(streams) AS BIGINT) AS streams, CAST(3 AS INTEGER) AS published
FROM held GROUP BY 1"""


def _engagement_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every order line as one stored engagement row."""
    rows = views.lines(spark, sf, "part")
    return rows.withColumns(
        {
            "provider": F.lit("demo"),
            "account_id": F.concat_ws("-", "order_key", "line_number"),
            "country_code": F.lit("US"),
        }
    )


def _stored_facts(spark: SparkSession, sf: str) -> SnapshotStore:
    """Engagement and spend as stored tables, by month."""
    store = SnapshotStore(spark, scratch_dir(spark, "facts"))
    store.replace(ENGAGEMENT, _engagement_rows(spark, sf))
    store.replace(BREAKDOWN, stored_rows(spark, sf))
    return store


def _numbers(rows: DataFrame) -> DataFrame:
    """Stored ids are text."""
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("campaign_id", "isrc") if c in rows.columns})


def stored_share(spark: SparkSession, sf: str) -> DataFrame:
    """A campaign's share on stored tables: spend windows open the months they touch only."""
    store = _stored_facts(spark, sf)
    facts = store.read(ENGAGEMENT, with_period=True)
    statement = views.statement(spark, sf)
    return _numbers(attribution.playlist_share(facts, store.read(BREAKDOWN), statement))


def sifted_share(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of campaigns with few recordings: the others leave the statement where it is read."""
    rows = views.lines(spark, sf)
    few = rows.where((F.col("engaged_track_isrc") % 5 == 2) | (F.col("engagement_context") != "playlist"))
    return attribution.playlist_share(few, rows, views.statement(spark, sf), sift=True)


SIFTED_SHARE = analyses.QUERIES["attributed_share_playlist"][1].replace(
    "JOIN (SELECT DISTINCT campaign_id, isrc FROM monthly)", "JOIN (SELECT DISTINCT campaign_id, isrc FROM monthly WHERE isrc % 5 = 2)"
)


def load_stamps(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by the instant of the load that last wrote them; an empty batch leaves no version."""
    store = SnapshotStore(spark, scratch_dir(spark, "stamps"))
    batches = _batches(spark, sf)
    for number, batch in enumerate([batches[0], batches[1].limit(0), *batches[1:]]):
        upsert(store, BREAKDOWN, batch, SYNCED + timedelta(hours=number), ORDER)
    seconds = (F.unix_seconds("synced_at") - int((SYNCED - datetime(1970, 1, 1)).total_seconds())).alias("seconds")
    stamped = store.read(BREAKDOWN).groupBy(seconds).agg(F.count(F.lit(1)).alias("n_rows"))
    return stamped.withColumn("published", F.lit(store.version(BREAKDOWN)))


LOAD_STAMPS = f"""{_GIVEN}
SELECT CAST(CASE batch WHEN 1 THEN 0 ELSE batch * 3600 END AS BIGINT) AS seconds, COUNT(*) AS n_rows,
  CAST(3 AS INTEGER) AS published
FROM held GROUP BY batch"""


def envelope_refusal(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers landed one by one, every fifth without its envelope's data."""
    key, spec = F.col("s_suppkey"), link_specs()["entities"]
    known = {
        spec.source_name(f.name): F.lit("2001-07-20T00:00:00Z" if f.name == "created_at" else "x")
        for f in spec.fields
        if f.name in spec.required
    }
    item = F.struct(*[v.alias(n) for n, v in (known | {"linkId": key.cast("string")}).items()])
    envelope = F.when(key % 5 == 0, F.lit('{"meta": {}}')).otherwise(F.to_json(F.struct(item.alias("data"))))
    path = scratch_dir(spark, "envelopes")
    landed = spread(views.table(spark, sf, "supplier").select(envelope.alias("value"), key), "s_suppkey")
    landed.write.partitionBy("s_suppkey").text(path)
    return quality.fault_report(read_entity(spark, path, spec))


ENVELOPE_REFUSAL = """
SELECT CASE WHEN s_suppkey % 5 = 0 THEN 'undecodable' ELSE 'ok' END AS fault, COUNT(*) AS rows
FROM supplier GROUP BY fault"""


def stored_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Position bands on stored sums of both tables instead of the facts."""
    store = _stored_facts(spark, sf)
    parts = []
    for source, sums in ((ENGAGEMENT, engagement_sums(ENGAGEMENT)), (BREAKDOWN, spend_sums(BREAKDOWN))):
        refresh(store, source, sums)
        parts.append(store.read(sums.spec, with_period=True))
    return _numbers(attribution.position_bands(*parts))


def latest_links(spark: SparkSession, sf: str) -> DataFrame:
    """The newest rows of links, as of campaigns."""
    rows = views.lines(spark, sf, "country").withColumnRenamed("engaged_spotify_track_id", "link_id")
    key = ("link_id", "report_date", "country_code", "order_key", "line_number")
    return rollups.latest_rows(rows, (*key, "streams", "campaign_id"), (*key, "streams"), k=25)


LATEST_LINKS = f"""{_ROWS}
SELECT track_id AS link_id, report_date, country_code, order_key, line_number, streams FROM lines
ORDER BY report_date DESC, track_id, country_code, order_key, line_number, streams, campaign_id LIMIT 25"""


def raw_variant(spark: SparkSession, sf: str) -> DataFrame:
    """A field outside the contract, read from the stored VARIANT of the item after two loads."""
    known = {name: F.lit("x") for name in BREAKDOWN.required} | {
        BREAKDOWN.day: F.lit("2001-07-01"),
        "account_id": F.col("event_id").cast("string"),
    }
    line = F.struct(*[value.alias(name) for name, value in known.items()], F.lit("1.0").alias("schema_version"))
    text = F.concat(F.regexp_replace(F.to_json(line), r"\}$", ', "extra": '), "props", F.lit("}"))
    events = views.table(spark, sf, "events").withColumn("value", text)
    spec, store = BREAKDOWN.with_variant(), SnapshotStore(spark, scratch_dir(spark, "variants"))
    for part in (events.where("event_id % 3 != 0"), events.where("event_id % 2 = 0")):
        path = scratch_dir(spark, "props")
        part.select("value").write.text(path)
        jobs.load_export(store, spec, path, SYNCED)
    stored = store.read(spec)
    return stored.groupBy(raw_field(stored, "$.extra.k", "bigint").alias("k")).agg(F.count(F.lit(1)).alias("n_rows"))


RAW_VARIANT = """
SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, COUNT(*) AS n_rows
FROM events WHERE event_id % 3 <> 0 OR event_id % 2 = 0 GROUP BY k"""


QUERIES = {
    "raw_variant": (raw_variant, RAW_VARIANT),
    "sums_refresh": (sums_refresh, SUMS_REFRESH),
    "sums_refresh_scan": (sums_refresh_scan, SUMS_REFRESH_SCAN),
    "write_counts": (write_counts, WRITE_COUNTS),
    "replayed_batches": (replayed_batches, REPLAYED_BATCHES),
    "stored_share": (stored_share, analyses.QUERIES["attributed_share_playlist"][1]),
    "stored_bands": (stored_bands, analyses.QUERIES["position_bands"][1]),
    "latest_links": (latest_links, LATEST_LINKS),
    "sifted_share": (sifted_share, SIFTED_SHARE),
    "load_stamps": (load_stamps, LOAD_STAMPS),
    "envelope_refusal": (envelope_refusal, ENVELOPE_REFUSAL),
}
