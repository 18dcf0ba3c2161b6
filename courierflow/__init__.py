"""Courier-marketplace event analytics on Spark: ingestion, metrics and streams."""
