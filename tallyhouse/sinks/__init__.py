"""Sinks: keyed result tables, batch-numbered tables, databases, block writers."""
