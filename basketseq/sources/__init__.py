"""Scans, sinks, typed ingest and the mapping of the test tables."""
