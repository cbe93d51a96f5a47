"""What a campaign did, judged against the distributor's statement.

Every function answers for all campaigns at once, ``campaign_id`` being one of the keys; for
one campaign filter the inputs or the result. Engagement is reduced to months and statements to
(recording, month) before they meet, so no join sees a raw row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import money, month_of, ratio, round_half_away
from tidemark.operators.engagement import (
    OTHER,
    PROMOTED,
    engagement_monthly,
    in_context,
    own_tracks,
    split_promoted,
    streams_inside,
    track_days,
)
from tidemark.operators.sieve import sieve, sifted
from tidemark.operators.spread import Lookup, counted, spread_join
from tidemark.operators.windows import CAMPAIGN, spend_profile, spend_window, sums_within_window
from tidemark.session import pinned


# Labels of the periods around a campaign.
BEFORE, DURING, AFTER = "1_before", "2_during", "3_after"


def statement_monthly(statement: DataFrame) -> DataFrame:
    """Statement streams per recording and month, all countries."""
    return statement.groupBy("isrc", "month").agg(F.sum("streams").alias("distributor_streams"))


def revenue_rate(statement: DataFrame, currency: str = "USD") -> DataFrame:
    """Revenue per stream by recording and month; null where nothing was streamed.

    Grouped by currency as well, which adds no rows: a join on (isrc, month) then has a shuffle
    of its own, and adaptive execution can split a recording that most campaigns touched.
    """
    rows = statement.where(F.col("currency") == currency)
    sums = rows.groupBy("isrc", "month", "currency").agg(
        F.sum(money(F.col("revenue"))).alias("revenue"), F.sum("streams").alias("streams")
    )
    rate = ratio(F.col("revenue"), F.col("streams"))
    return sums.select("isrc", "month", rate.alias("revenue_per_stream"))


def attributed_share(
    monthly: DataFrame, statement: DataFrame, *keys: str, sift: bool = False
) -> DataFrame:
    """Campaign streams against all streams for every statement month of the touched recordings.

    ``monthly`` has one row per (campaign, keys, recording, month). Its months are folded into
    a map per recording, no longer than the campaign has months, so that one join on the
    recording serves both "which recordings" and "how many streams that month", and months
    without campaign streams count as zero.

    ``sift`` drops statement rows of other recordings where they are read, by a filter of fixed
    size, before they are summed and moved. It stores the months first, which pays where the
    statement lists far more than the campaigns touched.
    """
    if sift:
        monthly = pinned(monthly, "monthly")
        statement = sifted(statement, "isrc", sieve(monthly, "isrc"))
    touched = monthly.where(F.col("isrc").isNotNull()).groupBy(CAMPAIGN, *keys, "isrc")
    months = F.map_from_entries(F.collect_list(F.struct("month", "campaign_streams")))
    folded = touched.agg(months.alias("by_month"))
    joined = folded.join(statement_monthly(statement), "isrc")
    streams = F.coalesce(F.try_element_at("by_month", F.col("month")), F.lit(0).cast("bigint"))
    share = round_half_away(ratio(streams, F.col("distributor_streams")), 3)
    return joined.select(
        CAMPAIGN,
        *keys,
        "isrc",
        "month",
        streams.alias("campaign_streams"),
        "distributor_streams",
        share.alias("attributed_share"),
    )


def playlist_share(
    engagement: DataFrame, country_daily: DataFrame, statement: DataFrame, sift: bool = False
) -> DataFrame:
    """Attributed share per playlist recording and month."""
    rows = in_context(engagement, "playlist")
    monthly = engagement_monthly(rows, spend_window(country_daily))
    return attributed_share(monthly, statement, sift=sift)


def spillover_share(
    engagement: DataFrame, country_daily: DataFrame, statement: DataFrame, sift: bool = False
) -> DataFrame:
    """Attributed share per bucket, recording and month of track campaigns."""
    rows = split_promoted(engagement)
    monthly = engagement_monthly(rows, spend_window(country_daily), "bucket")
    return attributed_share(monthly, statement, "bucket", sift=sift)


def band_of(position: Column, edges: tuple[int, ...] = (10, 25)) -> Column:
    """Label of a playlist slot: 01-10, 11-25, 26+ for the default edges."""
    labels = F
    low = 1
    for edge in edges:
        labels = labels.when(position <= edge, f"{low:02d}-{edge:02d}")
        low = edge + 1
    return labels.otherwise(f"{low:02d}+")


def position_bands(
    engagement: DataFrame, country_daily: DataFrame, edges: tuple[int, ...] = (10, 25)
) -> DataFrame:
    """Track-days and streams per track-day by playlist slot, inside the spend window."""
    rows = in_context(engagement, "playlist")
    spread = ("isrc", "report_date")
    inside = sums_within_window(rows, spend_window(country_daily), track_days, spread)
    band = band_of(F.col("playlist_position"), edges).alias("position_band")
    return track_days(inside).groupBy(CAMPAIGN, band).agg(
        F.count(F.lit(1)).alias("track_days"),
        F.sum("streams").alias("streams"),
        round_half_away(F.avg("streams"), 1).alias("streams_per_track_day"),
    )


def period_compare(statement: DataFrame, tracks: DataFrame, windows: Lookup) -> DataFrame:
    """Statement streams per month before, during and after the spend months.

    ``tracks`` lists (campaign, recording). Streams are summed per campaign and month first, so
    counting months needs no distinct. A campaign without a window counts as after, like any
    comparison with an unknown month.
    """
    monthly = tracks.join(statement_monthly(statement), "isrc")
    by_month = monthly.groupBy(CAMPAIGN, "month").agg(F.sum("distributor_streams").alias("streams"))
    placed = spread_join(by_month, windows, CAMPAIGN, spread_by=("month",), how="left")
    period = (
        F.when(F.col("month") < month_of(F.col("first_day")), BEFORE)
        .when(F.col("month") <= month_of(F.col("last_day")), DURING)
        .otherwise(AFTER)
    )
    sums = placed.groupBy(CAMPAIGN, period.alias("period")).agg(
        F.count("month").alias("months"), F.sum("streams").alias("distributor_streams")
    )
    per_month = ratio(F.col("distributor_streams"), F.col("months"))
    return sums.withColumn("streams_per_month", round_half_away(per_month))


def playlist_periods(engagement: DataFrame, country_daily: DataFrame, statement: DataFrame):
    """Before, during and after for the recordings on the campaign's playlist."""
    tracks = own_tracks(in_context(engagement, "playlist"))
    return period_compare(statement, tracks, counted(spend_window(country_daily)))


def noise_cut(rows: DataFrame, windows: DataFrame, min_share: float = 0.05) -> DataFrame:
    """Other releases with at least ``min_share`` of the promoted recording's streams.

    The per-recording sums are stored once, because the campaign total and the comparison both
    read them; they carry the window so that later steps need not read the spend again.
    ``rows`` come from ``split_promoted``. A campaign without promoted streams keeps nothing.
    """
    inside = streams_inside(rows, windows, "bucket")
    streams = F.col("streams")
    in_bucket = {name: F.when(F.col("bucket") == name, streams) for name in (PROMOTED, OTHER)}
    per_track = pinned(
        inside.groupBy(CAMPAIGN, "isrc").agg(
            F.sum(in_bucket[PROMOTED]).alias("promoted"),
            F.sum(in_bucket[OTHER]).alias("other"),
            F.max("first_day").alias("first_day"),
            F.max("last_day").alias("last_day"),
        ),
        "bucket-totals",
    )
    promoted = per_track.groupBy(CAMPAIGN).agg(
        F.sum("promoted").alias("promoted_streams"),
        F.max("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
    )
    others = per_track.where(F.col("other").isNotNull()).select(
        CAMPAIGN, "isrc", F.col("other").alias("other_streams")
    )
    totals = counted(promoted)
    judged = spread_join(others, totals, CAMPAIGN, spread_by=("isrc",))
    share = Decimal(str(min_share))
    return judged.where(F.col("other_streams") >= F.lit(share) * F.col("promoted_streams"))


def spillover_periods(
    engagement: DataFrame,
    country_daily: DataFrame,
    statement: DataFrame,
    min_share: float = 0.05,
) -> DataFrame:
    """Before, during and after for the other releases that moved.

    They are stored once: their windows are counted and joined, and their recordings are joined.
    """
    moved = pinned(
        noise_cut(split_promoted(engagement), spend_window(country_daily), min_share), "moved"
    )
    windows = moved.groupBy(CAMPAIGN).agg(
        F.max("first_day").alias("first_day"), F.max("last_day").alias("last_day")
    )
    lookup = counted(windows)
    return period_compare(statement, moved.select(CAMPAIGN, "isrc"), lookup)


def recoup(
    monthly: DataFrame, statement: DataFrame, *keys: str, currency: str = "USD"
) -> DataFrame:
    """Campaign streams priced at the statement's rate, against all spend of the campaign.

    ``monthly`` carries ``spend_usd``. Without keys each campaign in it has one row, empty when
    nothing could be priced. With a bucket key do not add up
    ``spend_usd``: every bucket shows the whole spend.
    """
    rate = revenue_rate(statement, currency).withColumn("listed", F.lit(True))
    priced = monthly.join(rate, ["isrc", "month"], "inner" if keys else "left")
    worth = F.col("campaign_streams") * F.col("revenue_per_stream")
    sums = priced.groupBy(CAMPAIGN, *keys).agg(
        F.sum(worth.cast("decimal(38,12)")).cast("double").alias("worth"),
        F.max(F.when(F.col("listed"), F.col("spend_usd"))).alias("spend_usd"),
    )
    return sums.select(
        CAMPAIGN,
        *keys,
        round_half_away(F.col("worth"), 2).alias("attributed_revenue_estimate"),
        F.col("spend_usd").cast("double").alias("spend_usd"),
        round_half_away(ratio(F.col("worth"), F.col("spend_usd")), 3).alias("recoup_ratio"),
    )


def playlist_recoup(
    engagement: DataFrame, country_daily: DataFrame, statement: DataFrame, currency: str = "USD"
) -> DataFrame:
    """Rough recoup ratio of playlist campaigns, a row for every campaign with spend rows.

    The row is empty where the window holds no playlist engagement, or none could be priced.
    """
    rows = in_context(engagement, "playlist")
    profile = counted(spend_profile(country_daily))
    monthly = engagement_monthly(rows, profile, carry=("spend_usd",))
    # A row without a recording for every campaign: it prices nothing and keeps the campaign.
    every = profile.rows.select(CAMPAIGN)
    return recoup(monthly.unionByName(every, allowMissingColumns=True), statement, currency=currency)


def spillover_recoup(
    engagement: DataFrame, country_daily: DataFrame, statement: DataFrame, currency: str = "USD"
) -> DataFrame:
    """Rough recoup ratio per bucket of track campaigns."""
    rows = split_promoted(engagement)
    monthly = engagement_monthly(
        rows, spend_profile(country_daily), "bucket", carry=("spend_usd",)
    )
    return recoup(monthly, statement, "bucket", currency=currency)


def promoted_vs_other(engagement: DataFrame, country_daily: DataFrame) -> DataFrame:
    """Streams per bucket and recording inside the spend window, largest first.

    The track name stays a grouping key until the rows are few: only then one name is chosen.
    """
    inside = streams_inside(
        split_promoted(engagement), spend_window(country_daily), "bucket", "engaged_track_name"
    )
    named = inside.groupBy(CAMPAIGN, "bucket", "isrc", "engaged_track_name").agg(
        F.sum("streams").alias("streams")
    )
    rows = named.groupBy(CAMPAIGN, "bucket", "isrc").agg(
        F.max("engaged_track_name").alias("track_name"),
        F.sum("streams").alias("campaign_streams"),
    )
    return rows.orderBy(CAMPAIGN, "bucket", F.desc("campaign_streams"), "isrc")


REPORT_ORDER = (CAMPAIGN, "bucket", "position_band", "period", "isrc", "month")


def as_report(rows: DataFrame) -> DataFrame:
    """Sort an analysis the way it is read: by campaign, group, recording and month."""
    return rows.orderBy(*[name for name in REPORT_ORDER if name in rows.columns])
