"""Structured Streaming queries over the same operators as batch."""
