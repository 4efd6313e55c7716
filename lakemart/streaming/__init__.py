"""Incremental ingestion with Structured Streaming."""

from lakemart.streaming.ingest import stream_edition_to_bronze

__all__ = ["stream_edition_to_bronze"]
