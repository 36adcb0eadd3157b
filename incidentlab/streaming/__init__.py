"""Incremental ingest of feed files as they arrive (Structured Streaming)."""

from incidentlab.streaming.feeds import feed_stream, ingest_new_files

__all__ = ["feed_stream", "ingest_new_files"]
