"""Structured Streaming jobs over the same event operators as the batch queries."""
