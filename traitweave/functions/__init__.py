"""Column helpers: naming, arrays and scores. Everything here is plain Spark expressions."""
