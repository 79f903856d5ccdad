"""Structured Streaming entry points (questions arriving as a stream)."""
