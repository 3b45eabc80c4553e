"""Spark-native mesh normalization and quality-control analytics."""

__version__ = "0.1.0"
