"""Landed files and stored tables."""

from tidemark.sources.decode import decode_rows, raw_field, split_valid
from tidemark.sources.exports import (
    between_days,
    only_ids,
    read_export,
    read_lines,
    reconcile_counts,
    rejected_exports,
)
from tidemark.sources.pages import (
    EntityNotFound,
    check_pages,
    find_entity,
    read_entity,
    read_pages,
)
from tidemark.sources.snapshots import SnapshotStore
from tidemark.sources.statements import load_statement, read_statement

__all__ = [
    "EntityNotFound",
    "SnapshotStore",
    "between_days",
    "check_pages",
    "decode_rows",
    "find_entity",
    "load_statement",
    "only_ids",
    "raw_field",
    "read_entity",
    "read_export",
    "read_lines",
    "read_pages",
    "read_statement",
    "reconcile_counts",
    "rejected_exports",
    "split_valid",
]
