"""Sources and sinks: CSV/JSON/parquet readers, derived input views, run artifacts."""
