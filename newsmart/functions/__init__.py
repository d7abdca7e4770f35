"""Column functions: plain Spark expressions, usable in batch and streams."""
