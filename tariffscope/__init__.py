"""Hospital price-transparency analytics as Spark DataFrame jobs."""
