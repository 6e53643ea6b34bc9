"""Readers: JSON lines, CSV, parquet, config-driven scans, CSV records."""
