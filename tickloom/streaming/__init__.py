"""Structured Streaming: ingest flow, high-water filter, progress log."""
