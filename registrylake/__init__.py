"""Spark-native operators for public registry and endpoint data."""
