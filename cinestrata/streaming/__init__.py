"""Arriving files, each processed once."""
