"""Structured Streaming versions of the beach chain."""
