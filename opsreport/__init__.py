"""Daily production reporting for a mineral plant, as Spark DataFrame jobs."""

__version__ = "0.1.0"
