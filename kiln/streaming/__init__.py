"""Structured Streaming forms of the polled / periodic jobs."""
