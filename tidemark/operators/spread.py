"""Joins from facts to one-row-per-key lookups when a key may hold much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.session import pinned

# Lookup rows are a key and a few numbers or days, so this many are some 50 MB.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class Lookup:
    """One row per key, counted: ``small`` lookups may be broadcast."""

    rows: DataFrame
    small: bool


def counted(rows: DataFrame | Lookup) -> Lookup:
    """Count a lookup before it is joined; one that is counted already stays as it is.

    It is written to the shared folder, so that counting and joining do not compute it twice, and
    the job that writes it counts its rows.
    """
    if isinstance(rows, Lookup):
        return rows
    seen = Observation()
    kept = pinned(rows.observe(seen, F.count(F.lit(1)).alias("rows")), "lookup")
    return Lookup(kept, seen.get["rows"] <= BROADCAST_ROWS)


def spread_join(
    facts: DataFrame,
    lookup: Lookup,
    on: str | Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    salts: int | None = None,
) -> DataFrame:
    """Join facts to a lookup with one row per ``on``.

    A small lookup is broadcast and the facts stay where they are. A larger one is shuffled with
    the facts by (key, salt), so a key holding a third of the facts is worked on by ``salts``
    tasks, by default as many as the session has shuffle partitions. The salt leaves the row set
    and the result as they are.
    """
    on = [on] if isinstance(on, str) else list(on)
    if lookup.small:
        return facts.join(F.broadcast(lookup.rows), on, how)
    if salts is None:
        salts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    salted = facts.withColumn("_salt", salt)
    spread = lookup.rows.withColumn("_salt", copies).hint("merge")
    return salted.join(spread, [*on, "_salt"], how).drop("_salt")
