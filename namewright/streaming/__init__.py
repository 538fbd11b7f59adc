"""Structured Streaming views of the append-only logs and of arriving predictions."""
