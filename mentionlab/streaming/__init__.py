"""Structured Streaming forms of the operators; the batch twins live in ``operators``."""
