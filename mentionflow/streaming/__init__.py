"""Structured Streaming jobs; the same expressions as in batch."""
