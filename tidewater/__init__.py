"""Incremental ingest and delivery on Spark DataFrames."""
