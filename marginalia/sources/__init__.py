"""Readers: parquet tables, gzip JSON-lines shards, manifests, local listings."""
