"""Resumable, append-only ingestion with Structured Streaming."""
