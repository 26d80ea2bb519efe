"""Spark-native engine that turns web content into a searchable, citable knowledge base."""
