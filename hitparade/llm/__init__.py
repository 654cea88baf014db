"""Operators for preparing training text: tables of documents, pages and test items in, DataFrames out."""
