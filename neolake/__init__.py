"""Spark-native analytics for neoantigen epitope tables."""
