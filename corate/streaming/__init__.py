"""Incremental ingestion of rating logs with Structured Streaming."""

from corate.streaming.ingest import (
    compact,
    current_ratings,
    rating_events_table,
    rejected_lines,
    start_rating_ingest,
)

__all__ = ["compact", "current_ratings", "rating_events_table", "rejected_lines", "start_rating_ingest"]
