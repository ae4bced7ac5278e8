"""Customer-panel analytics as Spark jobs."""
