"""Station telemetry on Spark: decode, validate, de-duplicate, alert, route,
archive, keep latest values, and browse or replay what failed."""
