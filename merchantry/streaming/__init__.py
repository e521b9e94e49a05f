"""Bounded reading in chunks."""
