"""Spark-native analytics for radar-sounder traces."""
