"""Spark-native feature preparation and model training for agro-climate panels."""
