"""Sources and sinks: typed CSV / Parquet scans, writers, stand-in extracts."""
