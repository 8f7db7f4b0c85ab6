"""Structured Streaming sources, sinks and continuous operators."""
