"""Incremental ingestion and cleaning with Structured Streaming."""
