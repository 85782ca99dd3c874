"""Sources and sinks: telemetry derivation, CSV ingest, partitioned Parquet, seed."""
