"""Spark-native verification and export of extracted document tables."""
