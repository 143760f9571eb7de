"""Spark-native knowledge extraction, graph, search and evaluation operators."""
