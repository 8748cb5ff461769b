"""Machine telemetry analytics on Spark tables and streams."""
