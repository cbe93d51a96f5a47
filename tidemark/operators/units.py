"""Unit costs and rates derived from summed measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ratio, round_half_away

# Name: numerator, denominator, decimals. Fixed values.
UNIT_METRICS = {
    "cpl": ("spend_media", "listeners", 3),
    "cpf": ("spend_media", "followers", 3),
    "cpc_linkclick": ("spend_media", "link_clicks", 3),
    "ctr_linkclick": ("link_clicks", "impressions", 4),
    "ctr_adclick": ("ad_clicks", "impressions", 4),
    "streams_per_listener": ("streams", "listeners", 2),
    "ctr_lp": ("link_clicks", "views", 4),
    "spl": ("streams", "listeners", 2),
}


def unit_metrics(rows: DataFrame, *names: str) -> DataFrame:
    """Adds the named metrics, or all whose measures are present; null on an empty base."""
    wanted = names or [
        name
        for name, (top, bottom, _) in UNIT_METRICS.items()
        if {top, bottom} <= set(rows.columns)
    ]
    derived = {}
    for name in wanted:
        top, bottom, digits = UNIT_METRICS[name]
        derived[name] = round_half_away(ratio(F.col(top), F.col(bottom)), digits)
    return rows.withColumns(derived)
