"""Spark-native single-cell analytics on long-form expression tables."""
