"""Column functions; every one returns a built-in Spark expression."""
