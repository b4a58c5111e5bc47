"""Match-rating analytics as Spark DataFrame jobs."""
