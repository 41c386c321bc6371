"""Readers: every one returns a DataFrame and leaves pruning and pushdown to Catalyst."""
