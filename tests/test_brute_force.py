"""All-campaign analyses against a plain per-campaign calculation on random rows."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import samples
from tidemark.operators import attribution, spread

START = date(2026, 7, 20)
SPEND = "campaign_id string, report_date date, country_code string, spend_total double"
STATEMENT = "isrc string, month date, country_code string, streams bigint, revenue double, currency string"
TARGETED = (
    samples.ENGAGEMENT
    + ", campaign_target_type string, campaign_target_isrc string,"
    + " campaign_target_spotify_track_id string"
)


def half_away(value, digits=0):
    if value is None:
        return None
    scaled = math.floor(abs(value) * 10.0**digits + 0.5) / 10.0**digits
    return math.copysign(scaled, value) if scaled else 0.0


def month(day):
    return day.replace(day=1)


def divide(top, bottom):
    return None if top is None or not bottom else float(top) / float(bottom)


@pytest.fixture(scope="module", params=[(1, 500_000), (2, 500_000), (2, -1)], ids=str)
def data(request, spark):
    """Random rows; the second number is the lookup size up to which joins broadcast."""
    seed, spread.BROADCAST_ROWS = request.param
    rng = random.Random(seed)
    campaigns = [f"c{n}" for n in range(6)]
    codes = [None, "A", "B", "C", "D", "E"]
    targets = {
        c: (rng.choice(["track", "track", "playlist"]), rng.choice(codes), rng.choice(["t0", "t1", None]))
        for c in campaigns
    }
    engagement = []
    for _ in range(700):
        c = rng.choice(campaigns)
        engagement.append(
            (
                c,
                START + timedelta(days=rng.randrange(100)),
                rng.choice(["playlist", "catalog", "other"]),
                rng.choice(["US", "DE"]),
                f"t{rng.randrange(8)}",
                rng.choice(codes),
                "name",
                rng.choice([None, *range(1, 40, 3)]),
                rng.randrange(0, 30),
                *targets[c],
            )
        )
    spend = [
        (c, START + timedelta(days=rng.randrange(20, 80)), "US", rng.choice([0.0, 5.25, 7.5]))
        for c in campaigns[:5]
        for _ in range(8)
    ]
    spend += [("c4", row[1], "DE", 0.0) for row in spend if row[0] == "c4"]
    spend = [(c, d, k, 0.0 if c == "c4" else s) for c, d, k, s in spend]
    statement = [
        (
            rng.choice(codes[1:]),
            date(2026, rng.randrange(5, 13), 1),
            rng.choice(["US", "DE"]),
            rng.choice([0, 0, rng.randrange(200)]),
            round(rng.random() * 5, 2),
            rng.choice(["USD", "EUR"]),
        )
        for _ in range(60)
    ]
    frames = (
        spark.createDataFrame(engagement, TARGETED),
        spark.createDataFrame(spend, SPEND),
        spark.createDataFrame(statement, STATEMENT),
    )
    yield (engagement, spend, statement), frames
    spread.BROADCAST_ROWS = 500_000


def window(spend, campaign):
    days = [d for c, d, _, s in spend if c == campaign and s > 0]
    return (min(days), max(days)) if days else None


def statement_months(statement):
    sums = defaultdict(int)
    for isrc, m, _, streams, _, _ in statement:
        sums[isrc, m] += streams
    return sums


def bucket(row):
    promoted = row[4] == row[11] or (row[5] is not None and row[5] == row[10])
    return "promoted" if promoted else "other_releases"


def selected(rows, spend, campaign, context):
    span = window(spend, campaign)
    if span is None:
        return []
    return [
        r
        for r in rows
        if r[0] == campaign and r[2] == context and span[0] <= r[1] <= span[1]
    ]


def of_track_campaign(rows):
    return [r for r in rows if r[9] == "track" and r[5] is not None and r[11] is not None]


def collected(df):
    return {tuple(r) for r in df.collect()}


def campaigns_of(rows):
    return sorted({r[0] for r in rows})


def share_rows(rows, statement, key):
    """(key..., recording, month, campaign streams, all streams, share) of one campaign."""
    mine = defaultdict(int)
    for r in rows:
        mine[(*key(r), r[5], month(r[1]))] += r[8]
    touched = {k[:-1] for k in mine}
    found = set()
    for (isrc, m), total in statement_months(statement).items():
        for k in touched:
            if k[-1] == isrc:
                streams = mine.get((*k, m), 0)
                found.add((*k, m, streams, total, half_away(divide(streams, total), 3)))
    return found


def period_rows(tracks, span, statement):
    sums, months = defaultdict(int), defaultdict(set)
    for (isrc, m), total in statement_months(statement).items():
        if isrc in tracks:
            if span and m < month(span[0]):
                period = "1_before"
            elif span and m <= month(span[1]):
                period = "2_during"
            else:
                period = "3_after"
            sums[period] += total
            months[period].add(m)
    return {(p, len(months[p]), s, half_away(s / len(months[p]))) for p, s in sums.items()}


def rates(statement):
    revenue, streams = defaultdict(float), defaultdict(int)
    for isrc, m, _, n, amount, currency in statement:
        if currency == "USD":
            revenue[isrc, m] += amount
            streams[isrc, m] += n
    return {k: divide(revenue[k], streams[k]) for k in revenue}


def test_playlist_share(data):
    (rows, spend, statement), frames = data
    expected = {
        (c, *r)
        for c in campaigns_of(rows)
        for r in share_rows(selected(rows, spend, c, "playlist"), statement, lambda r: ())
    }
    assert expected and collected(attribution.playlist_share(*frames)) == expected


def test_spillover_share(data):
    (rows, spend, statement), frames = data
    expected = set()
    for c in campaigns_of(rows):
        mine = of_track_campaign(selected(rows, spend, c, "catalog"))
        expected |= {(c, *r) for r in share_rows(mine, statement, lambda r: (bucket(r),))}
    assert expected and collected(attribution.spillover_share(*frames)) == expected


def test_position_bands(data):
    (rows, spend, _), frames = data
    expected = set()
    for c in campaigns_of(rows):
        days = defaultdict(list)
        for r in selected(rows, spend, c, "playlist"):
            if r[7] is not None:
                days[r[1], r[5]].append(r)
        bands = defaultdict(list)
        for found in days.values():
            slot = min(r[7] for r in found)
            band = "01-10" if slot <= 10 else "11-25" if slot <= 25 else "26+"
            bands[band].append(sum(r[8] for r in found))
        expected |= {
            (c, band, len(n), sum(n), half_away(sum(n) / len(n), 1)) for band, n in bands.items()
        }
    assert expected and collected(attribution.position_bands(*frames[:2])) == expected


def test_playlist_periods(data):
    (rows, spend, statement), frames = data
    expected = set()
    for c in campaigns_of(rows):
        tracks = {r[5] for r in rows if r[0] == c and r[2] == "playlist" and r[7] is not None}
        expected |= {(c, *r) for r in period_rows(tracks, window(spend, c), statement)}
    assert expected and collected(attribution.playlist_periods(*frames)) == expected


def test_spillover_periods(data):
    (rows, spend, statement), frames = data
    expected = set()
    for c in campaigns_of(rows):
        promoted, others = 0, defaultdict(int)
        mine = of_track_campaign(selected(rows, spend, c, "catalog"))
        for r in mine:
            if bucket(r) == "promoted":
                promoted += r[8]
            else:
                others[r[5]] += r[8]
        if any(bucket(r) == "promoted" for r in mine):
            tracks = {isrc for isrc, n in others.items() if 100 * n >= 5 * promoted}
            expected |= {(c, *r) for r in period_rows(tracks, window(spend, c), statement)}
    assert collected(attribution.spillover_periods(*frames)) == expected


@pytest.mark.parametrize("by_bucket", [False, True])
def test_recoup(data, by_bucket):
    (rows, spend, statement), frames = data
    rate = rates(statement)
    expected = {}
    for c in campaigns_of(rows):
        mine = selected(rows, spend, c, "catalog" if by_bucket else "playlist")
        if by_bucket:
            mine = of_track_campaign(mine)
        total = sum(s for k, _, _, s in spend if k == c)
        groups = defaultdict(list)
        for r in mine:
            groups[(c, bucket(r)) if by_bucket else (c,)].append(r)
        for key, found in groups.items():
            listed = [r for r in found if (r[5], month(r[1])) in rate]
            priced = [r[8] * rate[r[5], month(r[1])] for r in listed if rate[r[5], month(r[1])] is not None]
            if by_bucket and not listed:
                continue
            worth = sum(priced) if priced else None
            expected[key] = (
                None if worth is None else round(worth, 2),
                total if listed else None,
                None if worth is None else round(worth / total, 3),
            )
    function = attribution.spillover_recoup if by_bucket else attribution.playlist_recoup
    size = 2 if by_bucket else 1
    found = {tuple(r)[:size]: tuple(r)[size:] for r in function(*frames).collect()}
    assert expected and found.keys() == expected.keys()
    for key, values in expected.items():
        for value, wanted in zip(found[key], values, strict=True):
            assert (value is None) == (wanted is None)
            assert value is None or value == pytest.approx(wanted, abs=0.0101)


def test_promoted_vs_other(data):
    (rows, spend, _), frames = data
    sums = defaultdict(int)
    for c in campaigns_of(rows):
        for r in of_track_campaign(selected(rows, spend, c, "catalog")):
            sums[c, bucket(r), r[5]] += r[8]
    found = attribution.promoted_vs_other(*frames[:2]).drop("track_name")
    assert collected(found) == {(*k, n) for k, n in sums.items()}
    listed = [(r[0], r[1], -r[3]) for r in found.collect()]
    assert listed == sorted(listed)


def test_one_campaign_is_a_filter(data):
    _, frames = data
    whole = attribution.playlist_share(*frames).where(F.col("campaign_id") == "c1")
    engagement, spend, statement = frames
    alone = attribution.playlist_share(
        engagement.where("campaign_id = 'c1'"), spend.where("campaign_id = 'c1'"), statement
    )
    assert collected(whole) == collected(alone)
