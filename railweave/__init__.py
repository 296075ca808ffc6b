"""railweave: multi-rail payments analytics as plain Spark DataFrame jobs."""
