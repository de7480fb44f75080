"""Spark-native analytics for hourly sensor series: ingest, repair, profile, model, report."""

__version__ = "0.1.0"
