"""Writers: versioned parquet tables, NDJSON, quarantine and dead-letter data."""
