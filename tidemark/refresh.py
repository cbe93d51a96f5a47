"""Sums kept beside a stored table, refreshed only where the table has changed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import money
from tidemark.schemas import TableSpec
from tidemark.sources.snapshots import SnapshotStore, with_period

BUILT_FROM = "built_from"
AMOUNT = T.DecimalType(38, 18)


@dataclass(frozen=True)
class StoredSums:
    """Where sums are stored, and how rows of some periods become sums of those periods."""

    spec: TableSpec
    build: Callable[[DataFrame], DataFrame]


def _sums_spec(source: TableSpec, name: str, keys: tuple[str, ...], sums: dict[str, T.DataType], day: str) -> TableSpec:
    kinds = {field.name: field.dataType for field in source.fields}
    fields = [T.StructField(key, kinds[key]) for key in keys] + [T.StructField(n, t) for n, t in sums.items()]
    return TableSpec(name, keys, T.StructType(fields), keys, day, grain=source.grain)


def engagement_sums(source: TableSpec) -> StoredSums:
    """Engagement without countries and accounts: every analysis gives the same on it."""
    noun_id = next(key for key in source.key if key.endswith("_id") and key != "account_id")
    noun = noun_id.removesuffix("_id")
    targets = (f"{noun}_target_{part}" for part in ("type", "isrc", "spotify_track_id"))
    track = ("engaged_spotify_track_id", "engaged_track_isrc", "engaged_track_name", "playlist_position")
    keys = (noun_id, "report_date", "engagement_context", *track, *targets)
    spec = _sums_spec(source, f"{source.name}_sums", keys, {"streams": T.LongType()}, "report_date")
    return StoredSums(spec, lambda rows: rows.groupBy(*keys).agg(F.sum("streams").alias("streams")))


def spend_sums(source: TableSpec) -> StoredSums:
    """Spend and counts per campaign and day, for spend windows and trailing roll-ups."""
    keys = ("campaign_id", "report_date")
    counts = ("impressions", "link_clicks", "streams", "followers")
    sums = {"spend_total": AMOUNT} | {name: T.LongType() for name in counts}
    spec = _sums_spec(source, f"{source.name}_sums", keys, sums, "report_date")

    def build(rows: DataFrame) -> DataFrame:
        totals = [F.sum(name).alias(name) for name in counts]
        return rows.groupBy(*keys).agg(F.sum(money(F.col("spend_total"))).cast(AMOUNT).alias("spend_total"), *totals)

    return StoredSums(spec, build)


def statement_sums(source: TableSpec) -> StoredSums:
    """Streams and revenue per recording, month and currency."""
    keys = ("isrc", "month", "currency")
    spec = _sums_spec(source, f"{source.name}_sums", keys, {"streams": T.LongType(), "revenue": AMOUNT}, "month")

    def build(rows: DataFrame) -> DataFrame:
        revenue = F.sum(money(F.col("revenue"))).cast(AMOUNT).alias("revenue")
        return rows.groupBy(*keys).agg(F.sum("streams").alias("streams"), revenue)

    return StoredSums(spec, build)


def refresh(store: SnapshotStore, source: TableSpec, sums: StoredSums) -> list[int]:
    """Bring stored sums up to date and return the periods that were built again.

    A snapshot names the write that holds each period, and the sums' snapshot keeps those names
    as of its building: a period whose write differs has changed, by an upsert, a late row or a
    replacement. Only changed periods are read and replaced; one that is gone, or has no rows
    left to sum, goes. The two snapshots are published one after the other, so sums may lag
    behind their table but never mix two states of a period.
    """
    version, base = store.version(source), store.version(sums.spec)
    writes = store.writes(source, version)
    known = {int(period): token for period, token in store.notes(sums.spec, base).get(BUILT_FROM, {}).items()}
    changed = sorted(p for p in {*writes, *known} if writes.get(p) != known.get(p))
    if not changed:
        return []
    rows = store.read(source, [p for p in changed if p in writes], version=version)
    built = with_period(sums.build(rows), sums.spec)
    store.write_periods(
        sums.spec, built, base, only=set(changed), drop=set(changed), notes={BUILT_FROM: {str(p): t for p, t in writes.items()}}
    )
    return changed
