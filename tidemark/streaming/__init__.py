"""Continuous ingest of dropped export files."""

from tidemark.streaming.ingest import late_split, on_time, stream_exports

__all__ = ["late_split", "on_time", "stream_exports"]
