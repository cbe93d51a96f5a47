"""Registered queries: attribution, rollups, retention and unit metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import month_of, round_half_away
from tidemark.lab import sql, views
from tidemark.operators import attribution, engagement, retention, rollups, units, windows
from tidemark.operators.engagement import in_context


def spend_window(spark: SparkSession, sf: str) -> DataFrame:
    return windows.spend_window(views.lines(spark, sf))


SPEND_WINDOW = f"{sql.with_views(sql.LINES, sql.WINDOWS)} SELECT * FROM windows"


def spend_months(spark: SparkSession, sf: str) -> DataFrame:
    return windows.spend_months(windows.spend_window(views.lines(spark, sf)))


SPEND_MONTHS = f"""{sql.with_views(sql.LINES, sql.WINDOWS)}
SELECT campaign_id, CAST(date_trunc('month', first_day) AS DATE) AS first_month,
  CAST(date_trunc('month', last_day) AS DATE) AS last_month FROM windows"""


def total_spend(spark: SparkSession, sf: str) -> DataFrame:
    spend = windows.total_spend(views.lines(spark, sf))
    return spend.select("campaign_id", F.col("spend_usd").cast("double").alias("spend_usd"))


TOTAL_SPEND = f"""{sql.with_views(sql.LINES, sql.SPEND)}
SELECT campaign_id, CAST(spend_usd AS DOUBLE) AS spend_usd FROM spend"""


def range_join_spend_window(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.lines(spark, sf).withColumn("engagements", F.lit(1))
    grain = ("report_date", "engagement_context")

    inside = windows.within_window(rows, windows.spend_window(rows), grain)
    return inside.groupBy("campaign_id", *grain, "first_day", "last_day").agg(
        F.sum("streams").alias("streams"), F.sum("engagements").alias("engagements")
    )


RANGE_JOIN = f"""{sql.with_views(sql.LINES, sql.WINDOWS)}
SELECT campaign_id, report_date, engagement_context, CAST(SUM(streams) AS BIGINT) AS streams,
  COUNT(*) AS engagements, first_day, last_day
FROM lines JOIN windows USING (campaign_id)
WHERE report_date BETWEEN first_day AND last_day GROUP BY ALL"""


def engagement_monthly(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.lines(spark, sf)
    spend = windows.spend_window(rows)
    return engagement.engagement_monthly(in_context(rows, "playlist"), spend)


ENGAGEMENT_MONTHLY = f"""{sql.with_views(sql.LINES, sql.WINDOWS, sql.PLAYLIST_MONTHLY)}
SELECT * FROM monthly"""


def track_days(spark: SparkSession, sf: str) -> DataFrame:
    return engagement.track_days(in_context(views.lines(spark, sf, "part"), "playlist"))


TRACK_DAYS = f"""{sql.with_views(sql.LINES)}
SELECT campaign_id, report_date, isrc, CAST(SUM(streams) AS BIGINT) AS streams,
  MIN(playlist_position) AS playlist_position
FROM lines WHERE engagement_context = 'playlist' AND playlist_position IS NOT NULL GROUP BY ALL"""


def position_bands(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.lines(spark, sf, "part")
    return attribution.position_bands(rows, views.lines(spark, sf))


POSITION_BANDS = f"""{sql.with_views(sql.LINES, sql.WINDOWS)},
track_days AS (
  SELECT campaign_id, report_date, isrc, SUM(streams) AS streams, MIN(playlist_position) AS slot
  FROM lines JOIN windows USING (campaign_id)
  WHERE engagement_context = 'playlist' AND playlist_position IS NOT NULL
    AND report_date BETWEEN first_day AND last_day GROUP BY ALL
)
SELECT campaign_id, CASE WHEN slot <= 10 THEN '01-10' WHEN slot <= 25 THEN '11-25' ELSE '26+' END
    AS position_band, COUNT(*) AS track_days, CAST(SUM(streams) AS BIGINT) AS streams,
  {sql.rounded("AVG(CAST(streams AS DOUBLE))", 1)} AS streams_per_track_day
FROM track_days GROUP BY campaign_id, position_band"""


def own_tracks(spark: SparkSession, sf: str) -> DataFrame:
    return engagement.own_tracks(in_context(views.lines(spark, sf, "part"), "playlist"))


OWN_TRACKS = f"""{sql.with_views(sql.LINES)}
SELECT DISTINCT campaign_id, isrc FROM lines
WHERE engagement_context = 'playlist' AND playlist_position IS NOT NULL"""

PERIODS = f"""
SELECT campaign_id, CASE WHEN month < date_trunc('month', first_day) THEN '1_before'
    WHEN month <= date_trunc('month', last_day) THEN '2_during' ELSE '3_after' END AS period,
  COUNT(DISTINCT month) AS months, CAST(SUM(distributor_streams) AS BIGINT) AS distributor_streams,
  {sql.rounded(sql.quotient("SUM(distributor_streams)", "COUNT(DISTINCT month)"))}
    AS streams_per_month
FROM tracks JOIN distributor USING (isrc) LEFT JOIN windows USING (campaign_id)
GROUP BY campaign_id, period"""


def playlist_periods(spark: SparkSession, sf: str) -> DataFrame:
    return attribution.playlist_periods(
        views.lines(spark, sf, "part"), views.lines(spark, sf), views.statement(spark, sf)
    )


PLAYLIST_PERIODS = f"""
{sql.with_views(sql.LINES, sql.WINDOWS, sql.STATEMENT, sql.DISTRIBUTOR)},
tracks AS (
  SELECT DISTINCT campaign_id, isrc FROM lines
  WHERE engagement_context = 'playlist' AND playlist_position IS NOT NULL
)
{PERIODS}"""


def revenue_rate(spark: SparkSession, sf: str) -> DataFrame:
    rate = attribution.revenue_rate(views.statement(spark, sf, "currency"))
    per_stream = round_half_away(F.col("revenue_per_stream"), 10)
    return rate.withColumn("revenue_per_stream", per_stream)


REVENUE_RATE = f"""{sql.with_views(sql.LINES, sql.STATEMENT, sql.RATE)}
SELECT isrc, month, {sql.rounded("revenue_per_stream", 10)} AS revenue_per_stream FROM rate"""


def attributed_share_playlist(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.lines(spark, sf)
    return attribution.playlist_share(rows, rows, views.statement(spark, sf))


ATTRIBUTED_SHARE_PLAYLIST = f"""
{sql.with_views(sql.LINES, sql.WINDOWS, sql.STATEMENT, sql.DISTRIBUTOR, sql.PLAYLIST_MONTHLY)}
SELECT p.campaign_id, d.isrc, d.month, COALESCE(campaign_streams, 0) AS campaign_streams,
  distributor_streams,
  {sql.rounded(sql.quotient("COALESCE(campaign_streams, 0)", "distributor_streams"), 3)}
    AS attributed_share
FROM distributor d
JOIN (SELECT DISTINCT campaign_id, isrc FROM monthly) p ON d.isrc = p.isrc
LEFT JOIN monthly m ON m.campaign_id = p.campaign_id AND m.isrc = d.isrc AND m.month = d.month"""


def attributed_share_spillover(spark: SparkSession, sf: str) -> DataFrame:
    return attribution.spillover_share(
        views.targeted(spark, sf), views.lines(spark, sf), views.statement(spark, sf)
    )


_SPLIT = (sql.LINES, sql.WINDOWS, sql.TARGETS)

ATTRIBUTED_SHARE_SPILLOVER = f"""
{sql.with_views(*_SPLIT, sql.STATEMENT, sql.DISTRIBUTOR, sql.SPLIT_MONTHLY)}
SELECT b.campaign_id, b.bucket, d.isrc, d.month, COALESCE(campaign_streams, 0) AS campaign_streams,
  distributor_streams,
  {sql.rounded(sql.quotient("COALESCE(campaign_streams, 0)", "distributor_streams"), 3)}
    AS attributed_share
FROM distributor d
JOIN (SELECT DISTINCT campaign_id, bucket, isrc FROM monthly) b ON d.isrc = b.isrc
LEFT JOIN monthly m ON m.campaign_id = b.campaign_id AND m.bucket = b.bucket
  AND m.isrc = d.isrc AND m.month = d.month"""


def promoted_vs_other(spark: SparkSession, sf: str) -> DataFrame:
    return attribution.promoted_vs_other(
        views.targeted(spark, sf, "part"), views.lines(spark, sf)
    )


PROMOTED_VS_OTHER = f"""{sql.with_views(*_SPLIT)}
SELECT campaign_id, bucket, isrc, MAX(track_name) AS track_name,
  CAST(SUM(streams) AS BIGINT) AS campaign_streams
FROM split GROUP BY campaign_id, bucket, isrc"""

_CUT = """
promoted AS (
  SELECT campaign_id, SUM(streams) AS promoted_streams FROM split
  WHERE bucket = 'promoted' GROUP BY campaign_id
),
kept AS (
  SELECT campaign_id, isrc, CAST(SUM(streams) AS BIGINT) AS other_streams,
    CAST(promoted_streams AS BIGINT) AS promoted_streams
  FROM split JOIN promoted USING (campaign_id) WHERE bucket = 'other_releases'
  GROUP BY campaign_id, isrc, promoted_streams
  HAVING SUM(streams) >= 0.05 * promoted_streams
)"""


def spillover_noise_cut(spark: SparkSession, sf: str) -> DataFrame:
    rows = engagement.split_promoted(views.targeted(spark, sf))
    kept = attribution.noise_cut(rows, windows.spend_window(views.lines(spark, sf)))
    return kept.select("campaign_id", "isrc", "other_streams", "promoted_streams")


SPILLOVER_NOISE_CUT = f"{sql.with_views(*_SPLIT, _CUT)} SELECT * FROM kept"


def spillover_periods(spark: SparkSession, sf: str) -> DataFrame:
    return attribution.spillover_periods(
        views.targeted(spark, sf), views.lines(spark, sf), views.statement(spark, sf)
    )


SPILLOVER_PERIODS = f"""{sql.with_views(*_SPLIT, sql.STATEMENT, sql.DISTRIBUTOR, _CUT)},
tracks AS (SELECT campaign_id, isrc FROM kept)
{PERIODS}"""

_WORTH = "SUM(campaign_streams * revenue_per_stream)"


def recoup_playlist(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.lines(spark, sf)
    return attribution.playlist_recoup(rows, rows, views.statement(spark, sf, "currency"))


_PRICING = (sql.STATEMENT, sql.RATE, sql.SPEND)

RECOUP_PLAYLIST = f"""
{sql.with_views(sql.LINES, sql.WINDOWS, *_PRICING, sql.PLAYLIST_MONTHLY)}
SELECT campaign_id, {sql.rounded(_WORTH, 2)} AS attributed_revenue_estimate,
  CAST(ANY_VALUE(CASE WHEN r.isrc IS NOT NULL THEN spend_usd END) AS DOUBLE) AS spend_usd,
  {sql.rounded(sql.quotient(_WORTH, "ANY_VALUE(spend_usd)"), 3)} AS recoup_ratio
FROM spend LEFT JOIN monthly m USING (campaign_id)
LEFT JOIN rate r ON m.isrc = r.isrc AND m.month = r.month GROUP BY campaign_id"""


def recoup_empty(spark: SparkSession, sf: str) -> DataFrame:
    """The estimate where most campaigns have no playlist engagement left: their rows are empty."""
    rows = views.lines(spark, sf)
    few = rows.where((F.col("campaign_id") % 7 == 0) | (F.col("engagement_context") != "playlist"))
    return attribution.playlist_recoup(few, rows, views.statement(spark, sf, "currency"))


def recoup_spillover(spark: SparkSession, sf: str) -> DataFrame:
    return attribution.spillover_recoup(
        views.targeted(spark, sf), views.lines(spark, sf), views.statement(spark, sf, "currency")
    )


RECOUP_EMPTY = RECOUP_PLAYLIST.replace("monthly m USING", "(SELECT * FROM monthly WHERE campaign_id % 7 = 0) m USING")

RECOUP_SPILLOVER = f"""
{sql.with_views(*_SPLIT, *_PRICING, sql.SPLIT_MONTHLY)}
SELECT campaign_id, bucket, {sql.rounded(_WORTH, 2)} AS attributed_revenue_estimate,
  CAST(ANY_VALUE(spend_usd) AS DOUBLE) AS spend_usd,
  {sql.rounded(sql.quotient(_WORTH, "ANY_VALUE(spend_usd)"), 3)} AS recoup_ratio
FROM monthly JOIN rate USING (isrc, month) JOIN spend USING (campaign_id)
GROUP BY campaign_id, bucket"""


def latest_rows_topk(spark: SparkSession, sf: str) -> DataFrame:
    key = ("report_date", "campaign_id", "country_code")
    columns = ("campaign_id", "country_code", "report_date", "streams", "spend_usd")
    facts = views.country_daily(spark, sf)
    facts = facts.withColumn("spend_usd", F.col("spend_total").cast("double"))
    return rollups.latest_rows(facts, key, columns)


LATEST_ROWS_TOPK = f"""{sql.with_views(sql.LINES)}
SELECT campaign_id, country_code, report_date, CAST(SUM(streams) AS BIGINT) AS streams,
  CAST(SUM(spend_total) AS DOUBLE) AS spend_usd
FROM lines GROUP BY campaign_id, country_code, report_date
ORDER BY report_date DESC, campaign_id, country_code LIMIT 10"""


def trailing_rollup(spark: SparkSession, sf: str) -> DataFrame:
    facts = views.lines(spark, sf).withColumn("spend", F.col("l_extendedprice"))
    measures = {"spend": "spend", "streams": "streams"}
    totals = rollups.trailing_rollup(
        facts, views.campaigns(spark, sf), "campaign_id", measures, views.AS_OF
    )
    return totals.withColumn("spend", F.round("spend", 2))


TRAILING_ROLLUP = f"""{sql.with_views(sql.LINES)}
SELECT campaign_id, CASE WHEN s_acctbal < 0 THEN 'paused' ELSE 'active' END AS status,
  ROUND(SUM(l_extendedprice), 2) AS spend,
  CAST(SUM(streams) AS BIGINT) AS streams
FROM lines JOIN supplier ON campaign_id = s_suppkey
WHERE report_date >= DATE '2001-07-27' - INTERVAL 30 DAY GROUP BY ALL"""


def trailing_rollup_links(spark: SparkSession, sf: str) -> DataFrame:
    facts = views.lines(spark, sf).select(
        F.col("engaged_spotify_track_id").alias("link_id"),
        "report_date",
        F.col("line_number").cast("bigint").alias("views"),
        "streams",
    )
    links = views.table(spark, sf, "part").select(
        F.col("p_partkey").alias("link_id"), F.col("p_type").alias("status")
    )
    measures = {"views": "views", "streams": "streams"}
    return rollups.trailing_rollup(facts, links, "link_id", measures, views.AS_OF)


TRAILING_ROLLUP_LINKS = """
SELECT l_partkey AS link_id, p_type AS status, CAST(SUM(l_linenumber) AS BIGINT) AS views,
  CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS streams
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE CAST(l_shipdate AS DATE) >= DATE '2001-07-27' - INTERVAL 30 DAY GROUP BY ALL"""


def date_spine(spark: SparkSession, sf: str) -> DataFrame:
    spend = windows.spend_window(views.lines(spark, sf))
    spine = windows.date_spine(spend, ("US", "DE"))
    month = month_of(F.col("report_date")).alias("month")
    return spine.groupBy("campaign_id", "country_code", month).agg(
        F.count(F.lit(1)).alias("days")
    )


DATE_SPINE = f"""{sql.with_views(sql.LINES, sql.WINDOWS)}
SELECT campaign_id, country_code, CAST(date_trunc('month', d) AS DATE) AS month, COUNT(*) AS days
FROM (SELECT campaign_id, unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d
      FROM windows), (VALUES ('US'), ('DE')) c(country_code)
GROUP BY ALL"""


def cohort_retention(spark: SparkSession, sf: str) -> DataFrame:
    return retention.cohort_retention(views.activity(spark, sf), views.COHORT_AS_OF)


def _wide(n: int) -> str:
    passed = f"day_number = {n} AND passed"
    share = sql.rounded(sql.quotient("returned_so_far", "cohort_size"), 4)
    return f"""
  CAST(MAX(CASE WHEN {passed} THEN returned END) AS BIGINT) AS returned_on_day_{n},
  MAX(CASE WHEN {passed} THEN {share} END) AS retention_by_day_{n},
  CAST(MAX(CASE WHEN {passed} THEN streams END) AS BIGINT) AS streams_on_day_{n}"""


COHORT_RETENTION = f"""{sql.with_views(sql.COHORTS)}
SELECT cohort_date, cohort_size, {",".join(_wide(n) for n in range(1, 8))}
FROM long GROUP BY cohort_date, cohort_size"""


def retention_long(spark: SparkSession, sf: str) -> DataFrame:
    return retention.retention_long(cohort_retention(spark, sf), "cohort_date")


RETENTION_LONG = f"""{sql.with_views(sql.COHORTS)}
SELECT cohort_date, cohort_size, day_number, CASE WHEN passed THEN returned END AS returned,
  CASE WHEN passed THEN {sql.rounded(sql.quotient("returned_so_far", "cohort_size"), 4)} END
    AS retention,
  CASE WHEN passed THEN streams END AS streams
FROM long"""


def unit_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.lines(spark, sf)
    totals = rows.groupBy("campaign_id", "engagement_context").agg(
        F.sum("streams").alias("streams"),
        F.sum(F.col("line_number").cast("bigint")).alias("listeners"),
        F.count_if(F.col("line_number") == 7).alias("followers"),
        F.sum(F.col("engaged_track_isrc")).alias("link_clicks"),
        F.sum("engaged_spotify_track_id").alias("impressions"),
        F.count(F.lit(1)).alias("ad_clicks"),
        F.sum("spend_total").alias("spend_media"),
    )
    return units.unit_metrics(totals).drop("spend_media")


UNIT_METRICS = f"""{sql.with_views(sql.LINES)},
totals AS (
  SELECT campaign_id, engagement_context, CAST(SUM(streams) AS BIGINT) AS streams,
    CAST(SUM(line_number) AS BIGINT) AS listeners,
    COUNT(*) FILTER (line_number = 7) AS followers, CAST(SUM(isrc) AS BIGINT) AS link_clicks,
    CAST(SUM(track_id) AS BIGINT) AS impressions, COUNT(*) AS ad_clicks,
    SUM(spend_total) AS spend_media
  FROM lines GROUP BY ALL
)
SELECT * EXCLUDE (spend_media),
  {sql.rounded(sql.quotient("spend_media", "listeners"), 3)} AS cpl,
  {sql.rounded(sql.quotient("spend_media", "followers"), 3)} AS cpf,
  {sql.rounded(sql.quotient("spend_media", "link_clicks"), 3)} AS cpc_linkclick,
  {sql.rounded(sql.quotient("link_clicks", "impressions"), 4)} AS ctr_linkclick,
  {sql.rounded(sql.quotient("ad_clicks", "impressions"), 4)} AS ctr_adclick,
  {sql.rounded(sql.quotient("streams", "listeners"), 2)} AS streams_per_listener,
  {sql.rounded(sql.quotient("streams", "listeners"), 2)} AS spl
FROM totals"""


QUERIES = {
    "attributed_share_playlist": (attributed_share_playlist, ATTRIBUTED_SHARE_PLAYLIST),
    "position_bands": (position_bands, POSITION_BANDS),
    "playlist_periods": (playlist_periods, PLAYLIST_PERIODS),
    "recoup_playlist": (recoup_playlist, RECOUP_PLAYLIST),
    "recoup_empty": (recoup_empty, RECOUP_EMPTY),
    "promoted_vs_other": (promoted_vs_other, PROMOTED_VS_OTHER),
    "attributed_share_spillover": (attributed_share_spillover, ATTRIBUTED_SHARE_SPILLOVER),
    "spillover_noise_cut": (spillover_noise_cut, SPILLOVER_NOISE_CUT),
    "spillover_periods": (spillover_periods, SPILLOVER_PERIODS),
    "recoup_spillover": (recoup_spillover, RECOUP_SPILLOVER),
    "spend_window": (spend_window, SPEND_WINDOW),
    "spend_months": (spend_months, SPEND_MONTHS),
    "total_spend": (total_spend, TOTAL_SPEND),
    "range_join_spend_window": (range_join_spend_window, RANGE_JOIN),
    "engagement_monthly": (engagement_monthly, ENGAGEMENT_MONTHLY),
    "track_days": (track_days, TRACK_DAYS),
    "own_tracks": (own_tracks, OWN_TRACKS),
    "revenue_rate": (revenue_rate, REVENUE_RATE),
    "latest_rows_topk": (latest_rows_topk, LATEST_ROWS_TOPK),
    "trailing_rollup": (trailing_rollup, TRAILING_ROLLUP),
    "trailing_rollup_links": (trailing_rollup_links, TRAILING_ROLLUP_LINKS),
    "date_spine": (date_spine, DATE_SPINE),
    "cohort_retention": (cohort_retention, COHORT_RETENTION),
    "retention_long": (retention_long, RETENTION_LONG),
    "unit_metrics": (unit_metrics, UNIT_METRICS),
}
