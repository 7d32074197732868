"""encore: repeat-engagement analytics expressed as Spark jobs."""
