"""Spark-native analytics over tables of OHLCV time bars."""
