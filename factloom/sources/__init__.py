"""Readers: parquet tables, JSON exports, HTML tables, page lines."""
