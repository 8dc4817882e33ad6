"""Structured Streaming forms of ingest and yearly totals."""
