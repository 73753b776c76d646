"""Operators put together: silver, gold, the full build and the query catalogue."""
