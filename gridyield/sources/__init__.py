"""Catalogs, scans, ingest and sinks."""
