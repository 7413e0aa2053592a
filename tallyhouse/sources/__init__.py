"""Sources: stored tables, message streams, databases."""
