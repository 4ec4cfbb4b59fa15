"""Structured Streaming entry point: topic batches arriving over time."""
