"""Spark-native procurement analytics."""
