"""The twelve data-quality rules and the exception report they fill."""
