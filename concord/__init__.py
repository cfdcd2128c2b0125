"""Spark-native comparison and quality checking of catalogues."""
