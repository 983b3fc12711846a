"""Spark-native education warehouse operators."""
