"""Spark-native preparation of instruction-tuning text data."""

__version__ = "0.1.0"
