"""Multimodal dataset preparation, checking and scoring as Spark DataFrame operations."""
