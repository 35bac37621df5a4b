"""Incremental loading by day."""
