"""Whole runs from stored inputs to stored results."""
