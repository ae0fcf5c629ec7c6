"""Structured Streaming forms of the snapshot work."""
