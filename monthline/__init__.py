"""Monthly sales forecasting on Spark: ingest, checks, features, models, monitoring."""

__version__ = "0.1.0"
