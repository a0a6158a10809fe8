"""Structured Streaming ingestion of bar messages into bronze."""

from .ingest import bronze_batch, ingest_stream, message_stream, run_ingest  # noqa: F401
