"""Operators composed of DataFrame operations, written to hold under skewed keys."""
