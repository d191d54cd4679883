"""Sources (parquet tables, subject text directories) and CSV sinks."""
