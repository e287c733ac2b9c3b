"""Spark-native library for financial data pipelines."""
