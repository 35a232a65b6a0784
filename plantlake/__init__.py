"""Machine-telemetry lakehouse on Spark: landing files to bronze, silver, gold and an alert."""
