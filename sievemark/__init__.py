"""Sievemark: Spark-native operators that audit and repair detection label data."""

__version__ = "0.1.0"
