"""Scans and sinks: source databases, RAW files, staging and control tables."""
