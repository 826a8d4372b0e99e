"""Dataset-level operators: duplicates, lookups, repeated rows, per-group samples."""
