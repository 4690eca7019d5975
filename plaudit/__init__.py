"""Review analytics on Spark: lake, quality, sentiment, anomalies, topics, warehouse, streams."""

__version__ = "0.1.0"
