"""Structured Streaming forms of the ingest and of the velocity count."""
