"""Column helpers built from native Spark functions."""

from tidemark.functions.dates import (
    iso_date,
    month_of,
    own_offset_date,
    period_number,
    statement_month,
)
from tidemark.functions.numbers import money, ratio, round_half_away

__all__ = [
    "iso_date",
    "money",
    "month_of",
    "own_offset_date",
    "period_number",
    "ratio",
    "round_half_away",
    "statement_month",
]
