"""Incremental ingest over file streams."""
