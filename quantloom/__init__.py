"""Spark-native analytics of daily market data."""
