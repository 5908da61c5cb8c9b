"""Column functions. Everything here is a native Spark expression."""
