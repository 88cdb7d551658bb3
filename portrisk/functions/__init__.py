"""Column-level functions: everything here builds native Spark expressions."""
