"""tidemark: multi-source time-series KPI analytics on PySpark."""

__version__ = "0.1.0"
