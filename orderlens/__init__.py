"""Order-delivery analytics as Spark jobs."""
