"""Spark-native health-data lakehouse and analytics engine."""
