"""Structured Streaming twins of the three queries."""
