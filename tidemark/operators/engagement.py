"""Engagement facts reduced to the grains the analyses need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import month_of
from tidemark.operators.windows import CAMPAIGN, sums_within_window

# Labels of the two sides of a track campaign.
PROMOTED = "promoted"
OTHER = "other_releases"


def in_context(engagement: DataFrame, context: str) -> DataFrame:
    """Rows of one engagement context with the recording code under its short name."""
    rows = engagement.where(F.col("engagement_context") == context)
    return rows.withColumnRenamed("engaged_track_isrc", "isrc")


def daily_streams(rows: DataFrame, *keys: str, measures: dict[str, Column] | None = None):
    """Streams per campaign, day, recording and further keys, over countries and accounts."""
    extra = [column.alias(name) for name, column in (measures or {}).items()]
    grain = [CAMPAIGN, "report_date", "isrc", *keys]
    return rows.groupBy(*grain).agg(F.sum("streams").alias("streams"), *extra)


def streams_inside(rows: DataFrame, windows: DataFrame, *keys: str) -> DataFrame:
    """Engagement inside the spend window for sums of streams: rows, or sums of days."""
    spread = ("isrc", "report_date")
    return sums_within_window(rows, windows, lambda raw: daily_streams(raw, *keys), spread)


def engagement_monthly(
    rows: DataFrame, windows: DataFrame, *keys: str, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Campaign streams per recording and month inside the spend window.

    ``carry`` keeps window columns (they have one value per campaign) so that they need no
    second join.
    """
    inside = streams_inside(rows, windows, *keys)
    month = month_of(F.col("report_date")).alias("month")
    kept = [F.max(name).alias(name) for name in carry]
    grouped = inside.groupBy(CAMPAIGN, *keys, "isrc", month)
    return grouped.agg(F.sum("streams").alias("campaign_streams"), *kept)


def track_days(rows: DataFrame) -> DataFrame:
    """Best playlist slot and streams per campaign, day and recording on the playlist."""
    placed = rows.where(F.col("playlist_position").isNotNull())
    best = {"playlist_position": F.min("playlist_position")}
    return daily_streams(placed, measures=best)


def own_tracks(rows: DataFrame) -> DataFrame:
    """Recordings that stood on a campaign's playlist."""
    placed = rows.where(F.col("playlist_position").isNotNull())
    return placed.select(CAMPAIGN, "isrc").distinct()


def split_promoted(engagement: DataFrame, context: str = "catalog") -> DataFrame:
    """Rows of track campaigns with ``bucket``: the promoted recording or other releases.

    Promoted means the target's track id, or another id of the same recording code.
    """
    rows = in_context(engagement, context).where(
        (F.col("campaign_target_type") == "track")
        & F.col("isrc").isNotNull()
        & F.col("campaign_target_spotify_track_id").isNotNull()
    )
    same_track = F.col("engaged_spotify_track_id") == F.col("campaign_target_spotify_track_id")
    same_recording = F.col("isrc") == F.col("campaign_target_isrc")
    return rows.withColumn("bucket", F.when(same_track | same_recording, PROMOTED).otherwise(OTHER))
