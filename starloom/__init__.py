"""starloom: Spark-first analytics for exposure-by-exposure sky-survey tables."""
