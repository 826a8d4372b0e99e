"""Scalar cleaning rules as native Column expressions (no UDFs)."""
