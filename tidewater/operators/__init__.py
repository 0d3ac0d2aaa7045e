"""Table operators: SQL views, intersect, completeness, keyed upsert, cells."""
