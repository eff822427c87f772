"""Incremental ingest of newly arrived feed files."""
