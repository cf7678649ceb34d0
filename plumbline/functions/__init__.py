"""Column-level building blocks. All of them are native Spark expressions."""
