"""Spark-native operators for scored tables: contracts, drift, metrics, governance."""

__version__ = "0.1.0"
