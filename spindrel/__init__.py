"""Spindrel: a Spark-native engine that builds, maintains and queries a document knowledge base."""
