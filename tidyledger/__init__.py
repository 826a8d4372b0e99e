"""Retail data quality, curation and reconciliation as Spark DataFrame plans."""
