"""Clinical-event analytics as ordinary Spark DataFrame jobs."""
