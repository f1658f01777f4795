"""Incremental (Structured Streaming) ingestion of raw feeds into bronze."""
