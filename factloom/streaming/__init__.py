"""Structured Streaming front of the delta load."""
