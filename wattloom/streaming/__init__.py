"""Structured Streaming jobs over the same operators."""
