"""Sources and sinks: driver-table adapters, CSV/JSON/Parquet readers and writers, model I/O."""
