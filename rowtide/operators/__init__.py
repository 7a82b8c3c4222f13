"""Operators on rows and change rows."""
