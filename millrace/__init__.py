"""Spark-native operators for the detail and dimension layers of a real-time warehouse."""
