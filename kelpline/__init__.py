"""Batch analytics on Spark: contract-checked ingestion, quality tables, star schema, marts and releases."""
