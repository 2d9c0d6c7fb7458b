"""Policy-corpus analytics as Spark DataFrame jobs."""
