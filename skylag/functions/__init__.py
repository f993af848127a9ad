"""Column expressions. All of them are built from Spark's own functions."""
