"""Short-video engagement analytics as Spark jobs."""
