"""Structured Streaming ingest and its monitoring reports."""
