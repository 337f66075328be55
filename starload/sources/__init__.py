"""Sources and sinks: CSV landing, message envelopes, Parquet snapshots."""
