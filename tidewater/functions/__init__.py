"""Row-level column expressions (no Python per row)."""
