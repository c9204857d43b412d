"""Spark-native analytics engine: log rollups, count and binary models, tuned classifiers, ratings and segments."""
