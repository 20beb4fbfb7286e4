"""Column functions built from Spark's built-in functions."""
