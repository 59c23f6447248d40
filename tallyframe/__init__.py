"""Spark-native reconciliation, profiling and rule mining of tabular data."""
