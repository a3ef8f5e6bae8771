"""basketry: grocery-order analytics (load, staging, marts, star schema,
data quality and reports) as Spark DataFrame jobs."""

__version__ = "0.1.0"
