"""Hybrid mail retrieval and ranking as Spark DataFrame operators."""
