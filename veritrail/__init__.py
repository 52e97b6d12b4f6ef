"""Security-compliance analytics as Spark DataFrame jobs."""
