"""Incremental delivery: window ingest, window source, file-stream delivery, stream completeness."""
