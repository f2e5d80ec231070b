"""Structured Streaming entry points of the ingest stages."""
