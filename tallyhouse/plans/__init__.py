"""Whole runs: the daily valuation, and the queries over star-schema tables."""
