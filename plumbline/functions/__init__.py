"""Column functions: vectors, text, numerics. Everything here is built from Spark's own expressions."""
