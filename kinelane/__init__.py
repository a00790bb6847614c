"""Road-vehicle telemetry analytics as plain Spark DataFrame transforms."""
