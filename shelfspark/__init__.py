"""Spark-native product-catalog engine: curate, address, price, verify, publish."""
