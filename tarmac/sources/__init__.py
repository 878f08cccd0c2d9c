"""Sources and sinks: CSV/Parquet readers and writers, and the fixture adapter."""
