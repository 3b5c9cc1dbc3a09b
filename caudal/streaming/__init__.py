"""Incremental ingest with Structured Streaming."""

from caudal.streaming.ingest import (
    append_batch, commits, ingest_observations, ingest_pages, ingest_records, known_identities, lay_out, observation_stream,
    page_stream, read_ingested, read_sketches, record_stream,
)

__all__ = [
    "append_batch", "commits", "ingest_observations", "ingest_pages", "ingest_records", "known_identities", "lay_out",
    "observation_stream", "page_stream", "read_ingested", "read_sketches", "record_stream",
]
