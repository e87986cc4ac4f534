"""Incremental ingestion of a landing folder with Structured Streaming."""
