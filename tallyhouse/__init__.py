"""Brokerage account analytics as PySpark DataFrame and Structured Streaming plans."""
