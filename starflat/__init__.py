"""Spark-native flattening, data quality and incremental publishing."""
