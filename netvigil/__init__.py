"""Network-operations analytics on Spark: telemetry ingest, dashboards, forecasts, anomaly scores, alerts."""
