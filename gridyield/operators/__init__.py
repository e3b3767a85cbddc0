"""Relational operators on tall grid tables."""
