"""Spark-native analytics for object-grounding datasets."""
