"""Job-queue telemetry on Spark: lifecycle events, registries, stored results, worker snapshots and commands."""
