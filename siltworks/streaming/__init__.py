"""Bounded incremental ingestion with Structured Streaming."""
