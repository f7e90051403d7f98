"""tidemark: medallion analytics for event data, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
