"""Readers: JDBC with parallel slices, files, and source-shaped views of the given tables."""
