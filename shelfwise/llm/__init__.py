"""Operators that turn a raw document table into training data."""
