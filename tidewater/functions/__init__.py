"""Column expressions (``expr``): pure functions from Columns to Columns."""
