"""Operators, each from DataFrame to DataFrame."""
