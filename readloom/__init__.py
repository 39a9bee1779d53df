"""Spark-native operators for trend streams, co-membership graphs and sequencing reads."""
