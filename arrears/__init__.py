"""Monthly default indicators of a loan portfolio, computed as Spark DataFrame jobs."""
