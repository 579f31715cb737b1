"""Spark-native cleaning, screening and deduplication of property listings."""
