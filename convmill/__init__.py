"""Spark-native curation of conversational training data."""
