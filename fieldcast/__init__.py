"""Usage analytics for offline audio devices, expressed as Spark DataFrame jobs."""
