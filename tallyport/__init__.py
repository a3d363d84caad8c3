"""Commerce analytics as lazy Spark DataFrame jobs."""

__version__ = "0.1.0"
