"""Batch operators of the three queries."""
