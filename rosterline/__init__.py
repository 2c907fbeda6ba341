"""Spark-native tabular feature and scoring engine."""
