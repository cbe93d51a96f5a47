"""Table contracts: one spec per table drives decoding, validation, storage and upsert."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Versions the exports declare, and the days a retention row covers.
METRICS_VERSION = "1.0"
RETENTION_VERSION = "1.1"
RETENTION_DAYS = 7

STORED_EXTRAS = "raw_json string, synced_at timestamp"
RAW = "raw_json"


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(*columns: str) -> T.StructType:
    """'name type, name type' lists as one StructType, without needing a session."""
    pairs = [pair.split() for part in columns if part for pair in part.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class TableSpec:
    """Columns, key and partition day of a stored table.

    ``fields`` are the columns read from the source; ``required`` must be present and non-null
    there. ``day`` is the key column whose period partitions the stored table. The source item is
    kept as text, or parsed once as a VARIANT whose fields are read without parsing text again.
    """

    name: str
    key: tuple[str, ...]
    fields: T.StructType
    required: tuple[str, ...]
    day: str | None = None
    version: str | None = None
    grain: str = "month"
    camel_case: bool = False
    variant: bool = False

    @property
    def stored(self) -> T.StructType:
        extras = _struct(STORED_EXTRAS)
        if self.variant:
            extras = [T.StructField(f.name, T.VariantType() if f.name == RAW else f.dataType) for f in extras]
        return T.StructType(
            [T.StructField(f.name, f.dataType, True) for f in [*self.fields, *extras]]
        )

    def source_name(self, column: str) -> str:
        """Name of a column in the landed files."""
        if not self.camel_case:
            return column
        return re.sub(r"_(\w)", lambda m: m.group(1).upper(), column)

    def with_variant(self) -> TableSpec:
        """The same table with the source item as VARIANT; decide before the table is created."""
        return replace(self, variant=True)

    def partitioned_by(self, grain: str) -> TableSpec:
        """The same table split by 'month' or by 'day'; days suit very large facts."""
        return replace(self, grain=grain)


# The identifying and descriptive columns all exports share.
def _head(day: str, noun: str) -> str:
    return f"provider string, account_id string, {day} date, {noun}_id string"


def _about(day: str, noun: str) -> str:
    target = ("type", "isrc", "spotify_track_id", "playlist_id")
    return (
        f"schema_version string, {day}_timezone string, exported_at timestamp, {noun}_name string, "
        + ", ".join(f"{noun}_target_{part} string" for part in target)
    )


# Measure columns and types of the landed exports.
ENGAGED = (
    "engaged_track_isrc string, engaged_track_name string, playlist_position int, "
    "new_listeners bigint, returning_listeners bigint, listeners bigint, "
    "new_listener_streams bigint, returning_listener_streams bigint, streams bigint, spl double"
)

SPEND_AND_RATES = (
    "impressions bigint, ad_clicks bigint, link_clicks bigint, streams bigint, listeners bigint, "
    "followers bigint, streams_per_listener double, spend_media double, spend_total double, "
    "fees double, currency string, currency_account string, cpl double, cpf double, "
    "cpc_linkclick double, ctr_linkclick double, ctr_adclick double, cost_per_result double, "
    "result_type string"
)

VISITS = (
    "views bigint, link_clicks bigint, streams bigint, listeners bigint, new_listeners bigint, "
    "returning_listeners bigint, new_listener_streams bigint, returning_listener_streams bigint, "
    "followers bigint, streams_per_listener double, ctr_lp double"
)


def _country_daily(noun: str, measures: str) -> TableSpec:
    key = ("provider", "account_id", "report_date", f"{noun}_id", "country_code")
    fields = _struct(
        _head("report_date", noun), "country_code string", _about("report_date", noun), measures
    )
    name = f"{noun}_country_daily"
    return TableSpec(name, key, fields, key, "report_date", METRICS_VERSION)


def _engagement_daily(noun: str, status: str = "") -> TableSpec:
    key = (
        "provider", "account_id", "report_date", f"{noun}_id",
        "engagement_context", "country_code", "engaged_spotify_track_id",
    )
    fields = _struct(
        _head("report_date", noun),
        "engagement_context string, country_code string, engaged_spotify_track_id string",
        _about("report_date", noun),
        status,
        ENGAGED,
    )
    name = f"{noun}_engagement_daily"
    return TableSpec(name, key, fields, key, "report_date", METRICS_VERSION)


def _cohort_retention(noun: str) -> TableSpec:
    key = ("provider", "account_id", "cohort_date", f"{noun}_id", "country_code")
    by_day = ", ".join(
        f"returned_on_day_{n} bigint, retention_by_day_{n} double, streams_on_day_{n} bigint"
        for n in range(1, RETENTION_DAYS + 1)
    )
    fields = _struct(
        _head("cohort_date", noun),
        "country_code string",
        _about("cohort_date", noun),
        "cohort_size bigint",
        by_day,
    )
    name = f"{noun}_cohort_retention_daily"
    return TableSpec(name, key, fields, key, "cohort_date", RETENTION_VERSION)


def _entities(noun: str, plural: str, columns: str, optional: tuple[str, ...]) -> TableSpec:
    fields = _struct(f"{noun}_id string, organization_id string", columns)
    required = tuple(name for name in fields.names if name not in optional)
    return TableSpec(plural, (f"{noun}_id",), fields, required, camel_case=True)


def campaign_specs() -> dict[str, TableSpec]:
    """The campaign family by role: entities, breakdown, engagement."""
    entities = _entities(
        "campaign",
        "campaigns",
        "status string, social_platform string, daily_budget double, total_budget double, "
        "campaign_duration int, generation int, created_at timestamp, updated_at timestamp, "
        "strategy_type string",
        optional=("strategy_type",),
    )
    return {
        "entities": entities,
        "breakdown": _country_daily("campaign", SPEND_AND_RATES),
        "engagement": _engagement_daily("campaign", "status string"),
    }


def link_specs(noun: str = "link") -> dict[str, TableSpec]:
    """The smart-link family by role; ``noun`` is the word the landed files use for a link."""
    entities = _entities(
        noun,
        f"{noun}s",
        "name string, url string, target_type string, spotify_url string, status string, "
        "created_at timestamp",
        optional=("target_type", "spotify_url"),
    )
    return {
        "entities": entities,
        "breakdown": _country_daily(noun, VISITS),
        "engagement": _engagement_daily(noun),
        "retention": _cohort_retention(noun),
    }


# Columns of a statement file.
STATEMENT_FIELDS = _struct(
    "isrc string, store string, sale_month string, country_code string, streams bigint, "
    "revenue double, currency string"
)

# Several lines may share a recording, month and country: this table is only replaced whole.
STATEMENT = TableSpec(
    "distributor_monthly",
    ("isrc", "month", "country_code"),
    _struct(
        "isrc string, month date, country_code string, streams bigint, revenue double, "
        "currency string"
    ),
    ("isrc", "month"),
    day="month",
)

PROGRESS = TableSpec(
    "sync_progress",
    ("run_key", "entity_id"),
    _struct("run_key string, entity_id string, mode string, entity string, error_count bigint"),
    ("run_key", "entity_id"),
)

LAST_SYNC = TableSpec(
    "sync_last",
    ("sync_key",),
    _struct(
        "sync_key string, mode string, entity string, sync_date date, entities bigint, "
        "breakdown_rows bigint, engagement_rows bigint, retention_rows bigint, "
        "soft_error_count bigint, single_id string"
    ),
    ("sync_key",),
)


def all_specs(noun: str = "link") -> list[TableSpec]:
    """The seven warehouse tables and the two control tables."""
    return [*campaign_specs().values(), *link_specs(noun).values(), PROGRESS, LAST_SYNC]
