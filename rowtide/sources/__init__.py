"""Stored histories."""
