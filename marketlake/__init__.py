"""marketlake: layered market-data analytics as Spark jobs."""
