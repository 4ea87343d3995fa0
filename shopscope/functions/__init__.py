"""Column-level helpers built from built-in Spark functions."""
