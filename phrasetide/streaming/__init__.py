"""Structured Streaming jobs around the same operators."""
