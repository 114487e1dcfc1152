"""Structured Streaming jobs over change rows."""
