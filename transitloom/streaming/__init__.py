"""Structured Streaming forms of the position path."""
