"""A small invented campaign: few tracks, three countries, round daily figures."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

CAMPAIGN = "north"
COUNTRIES = ("BR", "FR", "JP")
SPENT = date(2025, 3, 12), date(2025, 4, 5)
ENGAGED = date(2025, 3, 10), date(2025, 4, 20)
DAILY_SPEND = 4.0

# Monthly statement streams from February on, and what a stream pays in each store.
MONTHS = ("2025-02", "2025-03", "2025-04", "2025-05")
SOLD = {"Q1": (900, 1500, 1300, 1100), "Q2": (300, 280, 410, 350), "Q3": (5000, 5200, 5100, 5050)}
PAID = {"Spotify": 0.0045, "Deezer": 0.006}
COLUMNS = ("isrc", "store", "sale_month", "country_code", "streams", "revenue", "currency")

# Code, track id, slot on the playlist, streams per day and country.
ON_PLAYLIST = (("Q1", "t1", 8, 3), ("Q2", "t2", 25, 2), ("Q3", "t3", 31, 2), ("Q7", "t7", None, 4))
IN_CATALOG = (("Q1", "t1", None, 3), ("Q2", "t2", None, 2))
HEARD_ONCE = ("Q3", "t3", None, 1)

ENGAGEMENT = (
    "campaign_id string, report_date date, engagement_context string, country_code string, "
    "engaged_spotify_track_id string, engaged_track_isrc string, engaged_track_name string, "
    "playlist_position int, streams bigint"
)


def span(first: date, last: date) -> list[date]:
    return [first + timedelta(n) for n in range((last - first).days + 1)]


def statement_lines():
    for code, sold in SOLD.items():
        for month, streams in zip(MONTHS, sold):
            for store, paid in PAID.items():
                yield dict(zip(COLUMNS, (code, store, month, "FR", streams, f"{streams * paid:.4f}", "USD")))


def write_statement(path, columns=COLUMNS, more=()) -> str:
    """A statement as CSV; ``more`` are lines besides, ``columns`` the order of its header."""
    text = [",".join(columns)]
    text += [",".join(str(line.get(name, "-")) for name in columns) for line in (*statement_lines(), *more)]
    path.write_text("\n".join(text) + "\n")
    return str(path)


def spend(spark, campaign=CAMPAIGN):
    rows = [(campaign, day, country, DAILY_SPEND) for day in span(*SPENT) for country in COUNTRIES]
    return spark.createDataFrame(
        rows, "campaign_id string, report_date date, country_code string, spend_total double"
    )


def engagement(spark, tracks, context, campaign=CAMPAIGN, days=ENGAGED):
    rows = []
    for day in span(*days):
        for country in COUNTRIES:
            for code, track, slot, streams in tracks:
                rows.append((campaign, day, context, country, track, code, f"song {code}", slot, streams))
    return spark.createDataFrame(rows, ENGAGEMENT)


def targeted(rows, code="Q1", track="t1"):
    return rows.select(
        "*",
        F.lit("track").alias("campaign_target_type"),
        F.lit(code).alias("campaign_target_isrc"),
        F.lit(track).alias("campaign_target_spotify_track_id"),
    )


def catalog(spark):
    often = engagement(spark, IN_CATALOG, "catalog")
    once = engagement(spark, [HEARD_ONCE], "catalog", days=(SPENT[0], SPENT[0]))
    return targeted(often.unionByName(once))


def breakdown_line(**changes) -> dict:
    """One breakdown export row."""
    amounts = {"spend_media": 64.0, "fees": 16.0, "spend_total": 80.0}
    counts = {"impressions": 9310, "ad_clicks": 240, "link_clicks": 160}
    results = {"streams": 520, "listeners": 400, "followers": 16, "streams_per_listener": 1.3, "cpl": 0.16}
    names = {
        "provider": "tide",
        "account_id": "acc",
        "schema_version": "1.0",
        "report_date": "2026-04-01",
        "report_date_timezone": "Etc/UTC",
        "exported_at": "2026-04-03T00:30:00Z",
        "campaign_id": CAMPAIGN,
        "campaign_name": "North",
        "campaign_target_type": "playlist",
        "campaign_target_playlist_id": "list",
        "country_code": "US",
        "currency": "USD",
        "result_type": "stream",
    }
    return names | counts | amounts | results | changes
