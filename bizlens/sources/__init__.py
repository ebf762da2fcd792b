"""Sources (parquet scans, literal dimensions, canonical views) and sinks."""
