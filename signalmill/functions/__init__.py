"""Column expressions; all are built-in Spark functions."""
