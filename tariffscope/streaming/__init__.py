"""Incremental ingest as a file stream."""
