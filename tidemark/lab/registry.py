"""All registered queries by name: (function, SQL text or None)."""

from __future__ import annotations

from tidemark.lab import analyses, ingest, planning, stored


def registered() -> dict:
    return {**analyses.QUERIES, **ingest.QUERIES, **planning.QUERIES, **stored.QUERIES}
