"""Curated tables, business answers and report tables."""
