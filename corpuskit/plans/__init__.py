"""Registered query plans over the given tables."""
