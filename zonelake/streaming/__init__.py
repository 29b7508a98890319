"""Incremental ingest of landing files with Structured Streaming."""
