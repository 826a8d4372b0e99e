"""Readers for the raw extracts and the rules file."""
